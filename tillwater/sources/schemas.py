"""Column layouts of the input, silver and message tables (fixed values)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, StringType, StructField,
    StructType, TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "float": FloatType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "array<int>": ArrayType(IntegerType()),
}


def layout(columns: str) -> StructType:
    """``"a string, b int"`` as a StructType of nullable columns, without a session."""
    fields = []
    for column in columns.split(", "):
        name, kind = column.split(" ")
        fields.append(StructField(name, _TYPES[kind], True))
    return StructType(fields)


CLIENTS = layout(
    "client_id string, first_issue_date string, first_redeem_date string, age string, "
    "gender string, first_name string, middle_name string, last_name string"
)

PRODUCTS = layout(
    "product_id string, level_1 string, level_2 string, level_3 string, level_4 string, "
    "brand_name string, product_name string, product_price double, first_issue_date timestamp"
)

STORES = layout(
    "store_id string, store_name string, store_location string, region string, "
    "store_format string, first_issue_date timestamp"
)

PURCHASES = layout(
    "product_id string, client_id string, transaction_id string, "
    "transaction_datetime timestamp, regular_points_received double, purchase_sum double, "
    "store_id string, product_quantity double"
)

INSTAGRAM_COMMENTS = layout(
    "url string, comment_user string, comment_user_url string, comment_date string, "
    "comment string, likes_number int, replies_number int, replies string, "
    "hashtag_comment string, tagged_users_in_comment string, post_url string, "
    "post_user string, comment_id string, post_id string"
)

TIKTOK_COMMENTS = layout(
    "url string, post_url string, post_id string, post_date_created string, "
    "date_created string, comment_text string, num_likes string, num_replies string, "
    "commenter_user_name string, commenter_id string, commenter_url string, "
    "comment_id string, comment_url string"
)

TWITTER_POSTS = layout(
    "id string, user_posted string, name string, description string, date_posted string, "
    "photos int, url string, tagged_users string, replies string, reposts string, "
    "likes string, views string, external_url string, hashtags string, followers int, "
    "biography string, posts_count int, profile_image_link string, following int, "
    "is_verified string, quotes string, bookmarks string, parent_post_details string, "
    "external_image_urls string, videos int, quoted_post string"
)

PRODUCT_MESSAGE = layout(
    "productId int, ProductName string, brandName string, Description string, "
    "Price float, Weight float, Img string, categoryIds array<int>"
)

SILVER_USER = layout(
    "user_id string, display_name string, biography string, is_verified boolean, "
    "following int, followed int, post int, user_type string"
)

SILVER_POST = layout(
    "post_id string, user_id string, post_content string, post_date timestamp, "
    "post_url string, post_type string"
)
