"""HTML body and title features."""

from pyspark.sql import functions as F

# Patterns that decide what counts as markup and code.
TAG = r"<.*?>"
CODE_BLOCK = r"(?s)<code>.*?</code>"


def _plain(col):
    one_line = F.replace(F.regexp_replace(col, TAG, ""), F.lit("\n"), F.lit(" "))
    return F.trim(F.regexp_replace(one_line, "  +", " "))


def clean_html(col):
    """Text without markup: tags dropped, line feeds and runs of spaces to one space."""
    return _plain(F.replace(col, F.lit("&nbsp;"), F.lit(" ")))


def clean_html_nocode(col):
    """As `clean_html`, with whole code blocks removed first."""
    spaced = F.replace(col, F.lit("&nbsp;"), F.lit(" "))
    return _plain(F.regexp_replace(spaced, CODE_BLOCK, ""))


def _flag(condition):
    return F.when(condition, 1).otherwise(0)


def body_lengths(df, body="body"):
    """Add cleaned texts, their lengths and the share of code (null for an empty body).

    The cleaned text is generated, one for each row: a filter on its length is not pushed below that, where it
    would clean all texts once more.
    """
    clean_len = F.col("body_n_characters")
    nocode_len = F.col("body_nocode_n_characters")
    without_code = F.when(
        F.contains(F.col(body), F.lit("<code>")), clean_html_nocode(F.col(body))
    )
    return (
        df.select("*", F.explode(F.array(clean_html(F.col(body)))).alias("body_clean"))
        .withColumn("body_clean_nocode", without_code.otherwise(F.col("body_clean")))
        .withColumns(
            {
                "body_n_characters": F.length("body_clean"),
                "body_nocode_n_characters": F.length("body_clean_nocode"),
            }
        )
        .withColumn("body_code_perc", 1 - F.try_divide(nocode_len, clean_len))
    )


def _markup(raw, first, second):
    """Whether `second` occurs behind `first`; plain searches, whatever the text.

    Most texts lack `first`. That is found by bytes; places are counted in characters, which takes longer.
    """
    behind = F.locate(first, raw) + len(first)
    return F.contains(raw, F.lit(first)) & (F.call_function("locate", F.lit(second), raw, behind) > 0)


def html_flags(df, body="body"):
    """Add 0/1 flags for code, image, link and bold markup in the raw body."""
    raw = F.col(body)
    bold = _markup(raw, "<strong>", "</strong>") | _markup(raw, "<b>", "</b>")
    return df.withColumns(
        {
            "body_code_flag": _flag(_markup(raw, "<code>", "</code>")),
            "body_image_flag": _flag(_markup(raw, "<img", ">")),
            "body_link_flag": _flag(_markup(raw, "<a href", "</a>")),
            "body_bold_flag": _flag(bold),
        }
    )


def title_flags(df, title="title"):
    """Add flags for an upper-case first letter and a closing question mark, and the length."""
    text = F.col(title)
    return df.withColumns(
        {
            "title_upper_flag": _flag(text.rlike("^[A-Z]")),
            "title_question_flag": _flag(text.endswith("?")),
            "title_n_characters": F.length(text),
        }
    )
