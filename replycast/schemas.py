"""Dump entities: XML attribute, column name and type, in output order."""

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    fields: tuple  # (attribute, column, type); type "time" is text parsed to a timestamp
    year_of: str | None = None  # timestamp column that gives the partition year
    year: str | None = None  # name of the partition column

    @property
    def read_schema(self):
        return T.StructType(
            [T.StructField("_" + attr, _READ_TYPES[kind]) for attr, _, kind in self.fields]
        )

    @property
    def columns(self):
        return [column for _, column, _ in self.fields]


_READ_TYPES = {
    "long": T.LongType(),
    "text": T.StringType(),
    "time": T.StringType(),
    "tags": T.StringType(),
    "bool": T.BooleanType(),
}

# Attribute names of the public dump format.
ENTITIES = {
    "badges": Entity(
        (
            ("Id", "id", "long"),
            ("UserId", "user_id", "long"),
            ("Name", "name", "text"),
            ("Date", "date", "time"),
            ("Class", "class", "long"),
            ("TagBased", "tag_based", "bool"),
        ),
        year_of="date",
        year="year",
    ),
    "comments": Entity(
        (
            ("Id", "id", "long"),
            ("PostId", "post_id", "long"),
            ("Score", "score", "long"),
            ("Text", "text", "text"),
            ("CreationDate", "creation_date", "time"),
            ("UserId", "user_id", "long"),
            ("ContentLicense", "content_license", "text"),
        ),
        year_of="creation_date",
        year="creation_year",
    ),
    "post_history": Entity(
        (
            ("Id", "id", "long"),
            ("PostHistoryTypeId", "post_history_type_id", "long"),
            ("PostId", "post_id", "long"),
            ("RevisionGUID", "revision_guid", "text"),
            ("CreationDate", "creation_date", "time"),
            ("UserId", "user_id", "long"),
            ("Text", "text", "text"),
            ("ContentLicense", "content_license", "text"),
        ),
        year_of="creation_date",
        year="creation_year",
    ),
    "post_links": Entity(
        (
            ("Id", "id", "long"),
            ("CreationDate", "creation_date", "time"),
            ("PostId", "post_id", "long"),
            ("RelatedPostId", "related_post_id", "long"),
            ("LinkTypeId", "link_type_id", "long"),
        ),
        year_of="creation_date",
        year="creation_year",
    ),
    "posts": Entity(
        (
            ("Id", "id", "long"),
            ("PostTypeId", "post_type_id", "long"),
            ("ParentId", "parent_id", "long"),
            ("AcceptedAnswerId", "accepted_answer_id", "long"),
            ("CreationDate", "creation_date", "time"),
            ("Score", "score", "long"),
            ("ViewCount", "view_count", "long"),
            ("Body", "body", "text"),
            ("OwnerUserId", "owner_user_id", "long"),
            ("OwnerDisplayName", "owner_display_name", "text"),
            ("LastEditorUserId", "last_editor_user_id", "long"),
            ("LastEditorDisplayName", "last_editor_display_name", "text"),
            ("LastEditDate", "last_edit_date", "time"),
            ("LastActivityDate", "last_activity_date", "time"),
            ("Title", "title", "text"),
            ("Tags", "tags", "tags"),
            ("AnswerCount", "answer_count", "long"),
            ("CommentCount", "comment_count", "long"),
            ("FavoriteCount", "favorite_count", "long"),
            ("CommunityOwnedDate", "community_owned_date", "time"),
            ("ClosedDate", "closed_date", "time"),
            ("ContentLicense", "content_license", "text"),
        ),
        year_of="creation_date",
        year="creation_year",
    ),
    "tags": Entity(
        (
            ("Id", "id", "long"),
            ("TagName", "tag_name", "text"),
            ("Count", "count", "long"),
            ("ExcerptPostId", "excerpt_post_id", "long"),
            ("WikiPostId", "wiki_post_id", "long"),
        ),
    ),
    "users": Entity(
        (
            ("Id", "id", "long"),
            ("Reputation", "reputation", "long"),
            ("CreationDate", "creation_date", "time"),
            ("DisplayName", "display_name", "text"),
            ("LastAccessDate", "last_access_date", "time"),
            ("WebsiteUrl", "website_url", "text"),
            ("Location", "location", "text"),
            ("AboutMe", "about_me", "text"),
            ("Views", "views", "long"),
            ("UpVotes", "up_votes", "long"),
            ("DownVotes", "down_votes", "long"),
            ("ProfileImageUrl", "profile_image_url", "text"),
            ("AccountId", "account_id", "long"),
        ),
        year_of="creation_date",
        year="creation_year",
    ),
    "votes": Entity(
        (
            ("Id", "id", "long"),
            ("PostId", "post_id", "long"),
            ("VoteTypeId", "vote_type_id", "long"),
            ("UserId", "user_id", "long"),
            ("CreationDate", "creation_date", "time"),
            ("BountyAmount", "bounty_amount", "long"),
        ),
        year_of="creation_date",
        year="creation_year",
    ),
}

QUESTION, ANSWER = 1, 2
ACCEPTED, UP_VOTE, DOWN_VOTE = 1, 2, 3

REQUEST = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "forumName",
            "userId",
            "postTitle",
            "postBody",
            "postTags",
            "postDate",
            "postTime",
        )
    ]
)
