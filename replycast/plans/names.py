"""Column names of the training table and the model input.

Each dictionary maps a column of a feature table to its name in the training table, in output
order. Fixed values: the names and their order are part of the data model.
"""

QUESTION_NAMES = {
    "body": "post_body",
    "body_n_characters": "post_body_char_count",
    "body_nocode_n_characters": "post_body_nocode_char_count",
    "body_code_perc": "post_body_code_perc",
    "body_code_flag": "post_body_code_flag",
    "body_image_flag": "post_body_image_flag",
    "body_link_flag": "post_body_link_flag",
    "body_bold_flag": "post_body_bold_flag",
    "title": "post_title",
    "title_upper_flag": "post_title_upper_flag",
    "title_question_flag": "post_title_question_flag",
    "title_n_characters": "post_title_char_count",
    "tags": "post_tags",
    "n_tags": "post_tag_count",
}
WORD_CLASSES = {
    "verbs": "verb",
    "nouns": "noun",
    "pronouns": "pronoun",
    "adjectives": "adjective",
    "adverbs": "adverb",
}
TAG_NAMES = {
    "n_tag_posts_max": "tag_post_count_max",
    "n_tag_posts_max_30d": "tag_post_count_30d_max",
    "n_tag_posts_max_365d": "tag_post_count_365d_max",
    "tag_age_days_max": "tag_age_days_max",
    "n_tag_posts_avg": "tag_post_count_avg",
    "n_tag_posts_avg_30d": "tag_post_count_30d_avg",
    "n_tag_posts_avg_365d": "tag_post_count_365d_avg",
    "tag_age_days_avg": "tag_age_days_avg",
}
STATUS_NAMES = {
    "user_age_days": "user_age_days",
    "user_website_flag": "user_website_flag",
    "user_location_flag": "user_location_flag",
    "user_about_me_flag": "user_about_me_flag",
    "n_badges": "user_badge_count",
    "n_badges_class_1": "user_badge_1_count",
    "n_badges_class_2": "user_badge_2_count",
    "n_badges_class_3": "user_badge_3_count",
}
HISTORY_NAMES = {
    "n_user_posts": "user_post_count",
    "n_user_questions": "user_question_count",
    "n_user_answers": "user_answer_count",
    "user_first_post": "user_first_post_flag",
    "user_first_question": "user_first_question_flag",
    "n_user_answered_questions": "user_answered_questions_count",
    "n_user_accepted_answers": "user_accepted_answers_count",
    "user_score": "user_score",
    "user_question_score": "user_question_score",
    "user_answer_score": "user_answer_score",
}
ANSWER_NAMES = {
    "n_answers": "answer_count",
    "n_answers_1d": "answer_1d_count",
    "n_answers_30d": "answer_30d_count",
    "answered_flag": "answer_flag",
    "answered_1d_flag": "answer_1d_flag",
    "answered_7d_flag": "answer_7d_flag",
    "answered_14d_flag": "answer_14d_flag",
    "answered_30d_flag": "answer_30d_flag",
    "answer_max_score": "answer_max_score",
    "answer_max_score_1d": "answer_max_score_1d",
    "answer_max_score_30d": "answer_max_score_30d",
    "answer_accepted_flag": "answer_accepted_flag",
    "answer_accepted_1d_flag": "answer_accepted_1d_flag",
    "answer_accepted_7d_flag": "answer_accepted_7d_flag",
    "answer_accepted_14d_flag": "answer_accepted_14d_flag",
    "answer_accepted_30d_flag": "answer_accepted_30d_flag",
}

TARGET = "answer_accepted_7d_flag"
TARGETS = [
    "answer_1d_flag",
    "answer_7d_flag",
    "answer_14d_flag",
    "answer_30d_flag",
    "answer_accepted_1d_flag",
    "answer_accepted_7d_flag",
    "answer_accepted_14d_flag",
    "answer_accepted_30d_flag",
    "post_closed_flag",
]

DATE_FEATURES = ["post_hour", "post_dayofweek", "post_month", "post_year"]
BODY_WORD_FEATURES = [
    "post_body_sentence_count",
    "post_body_word_count",
    "post_body_word_distinct_count",
    *[f"post_body_{c}_perc" for c in WORD_CLASSES.values()],
]
TITLE_WORD_FEATURES = [
    "post_title_word_count",
    "post_title_word_distinct_count",
    *[f"post_title_{c}_perc" for c in WORD_CLASSES.values()],
    "post_title_in_body_perc",
]
_TEXTS = ("post_body", "post_title", "post_tags")
CANDIDATES = [
    *DATE_FEATURES,
    *[name for name in QUESTION_NAMES.values() if name not in _TEXTS],
    *BODY_WORD_FEATURES,
    *TITLE_WORD_FEATURES,
    *TAG_NAMES.values(),
    *STATUS_NAMES.values(),
    *HISTORY_NAMES.values(),
]
# Candidates left out of the model because others carry the same information.
DROPPED = [
    "user_badge_count",
    "post_body_word_count",
    "user_question_count",
    "tag_post_count_max",
    "tag_post_count_30d_max",
    "tag_post_count_365d_max",
    "tag_age_days_max",
]
# Forums the published model was trained on.
FORUMS = [
    "android-stackexchange-com",
    "askubuntu-com",
    "cs-stackexchange-com",
    "datascience-stackexchange-com",
    "dba-stackexchange-com",
    "devops-stackexchange-com",
    "gamedev-stackexchange-com",
    "raspberrypi-stackexchange-com",
    "softwareengineering-stackexchange-com",
    "unix-stackexchange-com",
]
