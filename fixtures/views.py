"""Views that bind the library's inputs to the test tables.

Each text runs unchanged in Spark and in DuckDB. They stand in for tables that a real deployment
has: a registry, works, page envelopes, responses.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pubwatch.functions import fixed
from pubwatch.functions.abstracts import build_inverted_index
from pubwatch.functions.text import let
from pubwatch.operators.joins import dimension_join
from pubwatch.operators.ranking import number_rows
from pubwatch.session import new_path, stored_bytes
from pubwatch.sources import schemas
from pubwatch.sources.landing import land_pages

PAGE_ROWS = 10
#: stored texts per partition that is cut into pages
TEXT_BYTES = 32 << 20
#: orders of that size are hashed for the join with the texts, so that the texts are not sorted
HASHED_BYTES = 64 << 20
#: landed lines are compressed, as cheaply as can be
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# name -> (tables and views it reads, text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "journals": (
        ("nation", "region"),
        """
        select concat('src', cast(n_nationkey as string)) as issn, n_nationkey as journal_ord,
               n_name as journal_name, r_name as subject,
               case when n_nationkey % 8 in (0, 1, 3, 4, 6) then 'Q1'
                    when n_nationkey % 8 = 2 then 'Q1/Q2' else 'Q2' end as grade,
               'Q1' as grade_alt
        from {nation} join {region} on n_regionkey = r_regionkey
        """,
    ),
    "works": (
        ("documents", "orders"),
        """
        select doc_id as work_id, source as issn,
               case when doc_id % 31 = 0 then null
                    else concat('Notes on ', source, ' & ', lang, ' <', cast(doc_id as string), '>: "',
                                cast(n_chars as string), ' characters"') end as title,
               cast(o_orderdate as date) as publication_date,
               cast(floor(o_totalprice / 1000) as bigint) as cited_by_count,
               case when doc_id % 7 = 0 then null
                    else concat('https://doi.example/', cast(doc_id as string)) end as doi,
               concat('https://works.example/W', cast(doc_id as string)) as id,
               case when doc_id % 11 = 0 then null else text end as abstract
        from {documents} join {orders} on doc_id = o_orderkey
        """,
    ),
    "journals_big": (
        ("supplier", "nation"),
        """
        select cast(s_suppkey as string) as issn, s_suppkey as journal_ord, s_name as journal_name,
               n_name as subject,
               case when s_acctbal >= 5000 then 'Q1' when s_acctbal >= 3000 then 'Q1/Q2'
                    else 'Q2' end as grade
        from {supplier} join {nation} on s_nationkey = n_nationkey
        """,
    ),
    "works_big": (
        ("lineitem",),
        """
        select cast(l_suppkey as string) as issn, l_orderkey, l_linenumber,
               concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as work_id,
               cast(l_shipdate as date) as publication_date,
               cast(l_quantity as bigint) as cited_by_count
        from {lineitem}
        """,
    ),
    "bilingual_responses": (
        ("conversations",),
        """
        select u.conv_id, u.turn,
               case when (u.conv_id + u.turn) % 5 = 0 then u.text
                    when (u.conv_id + u.turn) % 7 = 0
                      then concat('Hebrew: ', coalesce(a.text, ''), ' English: ', u.text)
                    else concat('English: ', u.text, chr(10), 'Hebrew: ', coalesce(a.text, '')) end
                 as response
        from {conversations} u
        left join {conversations} a on u.conv_id = a.conv_id and u.turn + 1 = a.turn
        """,
    ),
    "attempts": (
        ("bilingual_responses",),
        """
        select conv_id, turn, (conv_id + turn) % 13 <> 0 as has_input,
               case when (conv_id + turn) % 6 < 3 then response end as response,
               case when (conv_id + turn) % 6 = 3 then '503 busy'
                    when (conv_id + turn) % 6 = 4 then 'code 429'
                    when (conv_id + turn) % 6 = 5 then 'bad request' end as error,
               (conv_id + turn) % 3 + 1 as attempts
        from {bilingual_responses}
        """,
    ),
    "linked_texts": (
        ("documents",),
        """
        select doc_id,
               concat('<a href=''#art-', cast(doc_id as string), '''>', text, '</a>',
                      '<a href="#art-', cast(n_chars as string), '">', lang, '</a>',
                      '<a href="/', source, '">', source, '</a>') as html
        from {documents}
        """,
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or one of the views, in Spark."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    inputs, text = VIEWS[name]
    tables = {i: view(spark, sf_dir, i) for i in inputs}
    if name == "works" and stored_bytes(spark, f"{sf_dir}/orders.parquet") > HASHED_BYTES:
        tables["orders"] = tables["orders"].hint("shuffle_hash")
    return spark.sql(text, **tables)


def view_sql(name: str) -> str:
    """The text of a view for DuckDB, where its inputs go by their own names."""
    inputs, text = VIEWS[name]
    return text.format(**{i: i for i in inputs})


@cache
def _cut_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The works cut into pages as an API would; the cut is written once per session, without texts."""
    # Works are numbered without their texts: a text's place in its file stands for it until the end.
    documents, orders = table(spark, sf_dir, "documents"), table(spark, sf_dir, "orders")
    place = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")
    places = documents.withColumn("text", place)
    texts = documents.select(place.alias("place"), F.col("text").alias("abstract"))
    order = [F.asc("issn"), F.desc("publication_date"), F.asc("work_id")]
    works = spark.sql(VIEWS["works"][1], documents=places, orders=orders)
    numbered = number_rows(works.withColumnRenamed("abstract", "place"), order, "fixture-works")
    starts = numbered.groupBy("issn").agg(
        F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row")
    )
    names = view(spark, sf_dir, "journals").select("issn", "journal_name")
    offset = F.col("row_no") - F.col("first_row")
    page_no = F.floor(offset / PAGE_ROWS).cast("long") + 1
    last_page = F.floor((F.col("last_row") - F.col("first_row")) / PAGE_ROWS).cast("long") + 1
    failed = (F.col("issn") == "src3") & (F.col("page_no") == 2)
    location = F.when(
        F.col("work_id") % 13 != 0,
        F.struct(F.struct(F.col("journal_name").alias("display_name")).alias("source")),
    )
    work = F.struct(
        "id",
        "doi",
        "title",
        F.col("publication_date").cast("string").alias("publication_date"),
        "cited_by_count",
        location.alias("primary_location"),
        "abstract",
    )
    results = F.transform(
        "works",
        lambda w: w.withField(
            "abstract_inverted_index", build_inverted_index(w["abstract"])
        ).dropFields("abstract"),
    )
    placed = (
        dimension_join(dimension_join(numbered, starts, "issn"), names, "issn")
        .withColumn("page_no", page_no)
        .withColumn("last_page", last_page)
    )
    # Texts move twice, to their works and to their pages, and are sorted only in small partitions.
    told = placed.where("place is not null").hint("shuffle_hash").join(texts, "place")
    parts = max(
        spark.sparkContext.defaultParallelism,
        -(-stored_bytes(spark, f"{sf_dir}/documents.parquet") // TEXT_BYTES),
    )
    pages = (
        told.unionByName(placed.where("place is null"), allowMissingColumns=True)
        .repartition(parts, "issn", "page_no")
        .groupBy("issn", "page_no", "last_page")
        .agg(F.collect_list(work).alias("works"))
    )
    landed = pages.select(
        "issn",
        "page_no",
        F.when(F.col("page_no") == 1, fixed.FIRST_CURSOR)
        .otherwise(F.concat(F.lit("c"), F.col("page_no").cast("string")))
        .alias("request_cursor"),
        F.when(failed, 500).otherwise(200).alias("status"),
        F.when(
            F.col("page_no") < F.col("last_page"),
            F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string")),
        ).alias("next_cursor"),
        F.when(~failed, results).alias("results"),
    )
    # a journal without works answers with an empty page
    silent = view(spark, sf_dir, "journals").join(starts, "issn", "left_anti")
    empty = silent.select(
        "issn",
        F.lit(1).cast("long").alias("page_no"),
        F.lit(fixed.FIRST_CURSOR).alias("request_cursor"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("next_cursor"),
        F.lit(None).cast(landed.schema["results"].dataType).alias("results"),
    )
    landed = landed.unionByName(empty).withColumn("attempt", F.lit(2).cast("long"))
    # some pages came back only at the second attempt
    again = (F.col("page_no") % 7 == 3) & (F.col("status") == 200)
    first = landed.where(again).withColumn("attempt", F.lit(1).cast("long"))
    first = first.withColumn("status", F.lit(500)).withColumn("results", F.lit(None).cast(empty.schema["results"].dataType))
    return landed.unionByName(first)


@cache
def _landed_path(spark: SparkSession, sf_dir: str) -> str:
    """The pages landed as JSON lines, once per session."""
    path = new_path(spark, "fixture-landed")
    _cut_pages(spark, sf_dir).write.options(**GZIP).json(f"{path}/json")
    land_pages(spark, f"{path}/json", f"{path}/parquet")
    return path


@cache
def event_files(spark: SparkSession, sf_dir: str) -> str:
    """The events as they would land: a folder per week, written oldest first, once per session."""
    path, events = new_path(spark, "fixture-events"), table(spark, sf_dir, "events")
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")) / 7)
    weeks = sorted(row[0] for row in events.select(week).distinct().collect())
    for number in weeks:
        events.where(week == number).coalesce(1).write.parquet(f"{path}/{number}")
    return path


def landed_json(spark: SparkSession, sf_dir: str) -> str:
    return f"{_landed_path(spark, sf_dir)}/json"


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.LANDED_PAGE).parquet(f"{_landed_path(spark, sf_dir)}/parquet")


# The same pages in long form, one row per work, for DuckDB.
PAGED_WORKS_SQL = f"""
    select *, case when issn = 'src3' and page_no = 2 then 500 else 200 end as status,
           case when page_no = 1 then '*' else concat('c', cast(page_no as string)) end
             as request_cursor,
           case when page_no = max(page_no) over (partition by issn) then null
                else concat('c', cast(page_no + 1 as string)) end as next_cursor
    from (select w.*, cast(floor((row_number() over (partition by w.issn
            order by publication_date desc, work_id) - 1) / {PAGE_ROWS}) as bigint) + 1 as page_no,
            case when work_id % 13 <> 0 then j.journal_name else 'Unknown Journal' end
              as journal_name, j.subject, j.grade
          from works w join journals j on w.issn = j.issn) p
"""


@cache
def raw_json(spark: SparkSession, sf_dir: str) -> str:
    """The landed pages as JSON lines with fields that no schema declares.

    Of the works without a title, those with an even number say so by a null, the others leave it out.
    """
    number = lambda w: F.regexp_extract(w["id"], "[0-9]+$", 0).cast("long")

    def sent(w: Column, json: Column) -> Column:
        no_title = w["title"].isNull() & (number(w) % 2 == 0)
        located = F.regexp_replace(json, r'"primary_location":\{', '"primary_location":{"version":"v1",')
        return F.concat(
            F.lit("{"),
            F.when(no_title, '"title":null,').otherwise(""),
            F.when(number(w) % 3 == 0, '"type":"article",').otherwise(""),
            F.when(number(w) % 5 == 0, '"open_access":{"is_oa":true},').otherwise(""),
            F.substring(F.when(number(w) % 7 == 0, located).otherwise(json), 2, 2**31 - 1),
        )

    told = lambda w: let(F.to_json(w), lambda json: sent(w, json))
    works = F.concat(F.lit('"results":['), F.array_join(F.transform("results", told), ","), F.lit("],"))
    keys = F.to_json(F.struct("issn", "page_no", "request_cursor", "status", "next_cursor", "attempt"))
    line = F.concat(F.lit('{"meta":{"api":2},'), F.coalesce(works, F.lit("")), F.substring(keys, 2, 2**31 - 1))
    path = new_path(spark, "fixture-raw")
    _cut_pages(spark, sf_dir).select(line.alias("value")).write.options(**GZIP).text(path)
    return path
