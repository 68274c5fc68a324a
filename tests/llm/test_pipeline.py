"""The pipeline's stages against plain versions, and the registered queries against their SQL."""

import random
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from replycast.llm import oracle, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(1)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(120):
        kind = rng.random()
        lines = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 30))) for _ in range(rng.randint(1, 5))]
        text = "\n".join(lines)
        if kind < 0.2:
            text = text.replace(" ", "### ")
        elif kind < 0.35 and rows:
            text = rng.choice(rows)[1]
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice("aaab"), len(text)))
        labels.append((i, int("###" not in text), 0))
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(
        1
    ).write.parquet(f"{folder}/documents.parquet")
    wanted = [(i, " ".join(rng.choices(vocabulary[:40], k=12))) for i in range(9)]
    spark.createDataFrame(wanted, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == COLUMNS
        rows = out.collect()
        docs = spark.createDataFrame(rows, out.schema)
        after = {r["doc_id"]: r for r in rows}
        if number == 0:
            assert set(after) == {i for i, r in before.items() if "###" not in r["text"]}
        if number == 1:
            seen = set()
            for i in sorted(before):
                kept = [x for x in before[i]["text"].split("\n") if len(x) < 20 or x not in seen]
                seen.update(before[i]["text"].split("\n"))
                assert after[i]["text"] == "\n".join(kept)
                assert after[i]["n_chars"] == len(after[i]["text"])
        if number == 2:
            # what line dedup emptied is one group, and the rest has nothing alike
            empty = min(i for i, r in before.items() if not r["text"])
            assert set(after) == {i for i, r in before.items() if r["text"]} | {empty}
        if number == 3:
            sizes, taken = Counter(), Counter()
            for r in before.values():
                sizes[r["source"]] += len(r["text"].split())
            for r in rows:
                taken[r["source"]] += len(r["text"].split())
            longest = max(len(r["text"].split()) for r in before.values())
            total = sum(sizes.values())
            want = {"a": total / 3, "b": 2 * total / 3}
            over = max(0, want["b"] - 3 * sizes["b"])
            assert abs(taken["a"] - want["a"] - over) <= longest and abs(taken["b"] - want["b"] + over) <= longest
        before = after


def test_run_gives_tokens(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def _plain(frame):
    """Rows as text; a column of whole numbers with nulls may come as floats."""
    whole = frame.apply(lambda c: c.astype("Int64") if c.isna().any() and c.dropna().map(lambda v: float(v).is_integer()).all() else c)
    return sorted(map(tuple, whole.astype(str).values))


@pytest.mark.parametrize("name", oracle.SQL)
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet/*.parquet'")
    mine = queries.QUERIES[name](spark, sf_dir).toPandas()
    other = con.execute(oracle.SQL[name]).fetchdf()
    columns = sorted(mine.columns)
    assert columns == sorted(other.columns)
    assert _plain(mine[columns]) == _plain(other[columns])
