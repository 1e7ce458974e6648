"""Delimited raw files -> typed tables.

Files are latin-1 text: read with the CSV source as whole lines (a separator
that never occurs, quoting off, ISO-8859-1 decoding), then split and typed
with built-in expressions.  Nothing aborts on a bad value: ``try_cast`` /
``try_to_date`` give NULL and the quality step decides what to quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.functions.columns import empty_to_null, flag_to_bool, parse_date

# Genre names of the public movie-ratings item file, in file order.
MOVIE_GENRES = ["unknown", "action", "adventure", "animation", "childrens", "comedy", "crime",
                "documentary", "drama", "fantasy", "film_noir", "horror", "musical", "mystery",
                "romance", "sci_fi", "thriller", "war", "western"]

ITEM_FIXED = 5    # item_id | title | release_date | video_release_date | url
USER_FIELDS = 5   # user_id | age | gender | occupation | zip_code
RATING_FIELDS = 4  # user_id \t item_id \t rating \t timestamp


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """Whole lines of a text file in the given encoding, blank lines dropped."""
    df = (spark.read.option("sep", "\u0000").option("quote", "").option("escape", "")
          .option("encoding", encoding).option("header", "false")
          .schema("value string").csv(path))
    return df.filter(F.length(F.trim(F.col("value"))) > 0)


def _fields(lines: DataFrame, sep: str) -> DataFrame:
    return lines.select("value", F.split(F.col("value"), sep, -1).alias("f"))


def split_malformed(lines: DataFrame, sep: str, min_fields: int) -> tuple[DataFrame, DataFrame]:
    """Q4: (well-formed, malformed) lines by field count."""
    f = _fields(lines, sep)
    ok = F.size("f") >= min_fields
    return f.filter(ok), f.filter(~ok).select("value")


def parse_items(lines: DataFrame, genres: list[str] = MOVIE_GENRES) -> DataFrame:
    """``id|title|dd-MMM-yyyy|video date|url|flag…`` -> typed items."""
    good, _ = split_malformed(lines, r"\|", ITEM_FIXED + len(genres))
    f = F.col("f")
    return good.select(
        f[0].try_cast("bigint").alias("item_id"),
        f[1].alias("title"),
        parse_date(empty_to_null(f[2])).alias("release_date"),
        parse_date(empty_to_null(f[3])).alias("video_release_date"),
        empty_to_null(f[4]).alias("url"),
        *[flag_to_bool(f[ITEM_FIXED + i]).alias(g) for i, g in enumerate(genres)])


def parse_users(lines: DataFrame) -> DataFrame:
    """``id|age|gender|occupation|zip`` -> typed users (zip stays text)."""
    good, _ = split_malformed(lines, r"\|", USER_FIELDS)
    f = F.col("f")
    return good.select(f[0].try_cast("bigint").alias("user_id"), f[1].try_cast("int").alias("age"),
                       empty_to_null(f[2]).alias("gender"), empty_to_null(f[3]).alias("occupation"),
                       empty_to_null(f[4]).alias("zip_code"))


def parse_ratings(lines: DataFrame) -> DataFrame:
    """``user\\titem\\trating\\tunix-seconds`` -> typed ratings; rated_at
    is the UTC wall time of the epoch seconds."""
    good, _ = split_malformed(lines, "\t", RATING_FIELDS)
    f = F.col("f")
    ts = f[3].try_cast("bigint")
    return good.select(f[0].try_cast("bigint").alias("user_id"), f[1].try_cast("bigint").alias("item_id"),
                       f[2].try_cast("int").alias("rating"), ts.alias("timestamp"),
                       F.to_timestamp_ntz(F.from_unixtime(ts, "yyyy-MM-dd HH:mm:ss")).alias("rated_at"))


def parse_lookup_names(lines: DataFrame, sep: str | None = None) -> DataFrame:
    """Genre (``name|id``) or occupation (one name per line) lists."""
    if sep is None:
        return lines.select(F.trim("value").alias("name"))
    f = F.split(F.col("value"), sep, -1)
    return lines.select(f[0].alias("name"), f[1].try_cast("int").alias("id"))


def parse_info(lines: DataFrame) -> DataFrame:
    """``943 users`` style counts -> (label, n)."""
    return lines.select(F.regexp_extract("value", r"^\s*(\d+)\s+(\w+)", 2).alias("label"),
                        F.regexp_extract("value", r"^\s*(\d+)", 1).try_cast("bigint").alias("n"))


# ---------------------------------------------------------------- rendering
# The driver's tables are rendered back to the raw formats in-plan so the
# parsers run on every row of them.

def render_items(items: DataFrame, genres: list[str]) -> DataFrame:
    d = F.coalesce(F.date_format("release_date", "dd-MMM-yyyy"), F.lit(""))
    flags = [F.col(g).cast("int").cast("string") for g in genres]
    return items.select(F.concat_ws("|", F.col("item_id").cast("string"), "title", d, F.lit(""), F.lit(""),
                                    *flags).alias("value"))


def render_users(users: DataFrame) -> DataFrame:
    return users.select(F.concat_ws("|", F.col("user_id").cast("string"), F.col("age").cast("string"),
                                    "gender", "occupation", "zip_code").alias("value"))


def render_ratings(ratings: DataFrame) -> DataFrame:
    secs = F.unix_timestamp(F.col("rated_at").cast("timestamp"))
    return ratings.select(F.concat_ws("\t", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
                                      F.col("rating").cast("string"), secs.cast("string")).alias("value"))
