"""File sources: Markdown, recognised text, JSON sidecars, findings and page overrides as DataFrames.

Readers take glob paths and push their work to the executors; nothing lists or opens files on the driver beyond what
Spark's readers do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINDING = "page int, severity string, kind string, detail string"
GOLDEN = (
    "page int, source string, must_have array<string>, must_not_have array<string>, max_title_count map<string,int>, "
    "max_heading_count map<string,int>, figure_order array<int>, callout_placement string, notes string, _corrupt string"
)
JOB = (
    "schema_version int, id string, title string, status string, profile string, source struct<file:string,original_filename:string,"
    "published_filename:string,sha256:string,language:string,expected_page_count:int>, product map<string,string>, "
    "extraction struct<chunk_size:int,levels:array<string>,features:map<string,boolean>>, output map<string,string>, _corrupt string"
)
CHUNK = "chunk_id string, start_page int, end_page int, path string"
SPAN = "group_id string, span_type string, start_page int, end_page int, title string, rotated boolean"
LAYOUT = (
    "doc_id string, page int, width double, height double, lines array<struct<y0:double,x0:double,y1:double,x1:double,dir_y:double,"
    "spans:array<struct<text:string,font:string,flags:int,size:double>>>>, tables array<struct<bbox:array<double>,rows:array<array<string>>>>, "
    "drawings array<struct<x0:double,y0:double,x1:double,y1:double,fill:array<double>>>, links array<struct<uri:string,y0:double,x0:double,anchor:string>>"
)


def _name() -> Column:
    return F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """Whole Markdown files: name, text."""
    return spark.read.text(path, wholetext=True).select(_name().alias("name"), F.col("value").alias("text"))


def recognised_text(spark: SparkSession, path: str) -> DataFrame:
    """Page files like page_012.txt as lines: page, line_no (from 1), line; blank lines are kept as paragraph marks."""
    files = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(_name(), r"(\d+)\.[^.]*$", 1).try_cast("int").alias("page"), F.regexp_replace("value", "\r\n?", "\n").alias("value")
    )
    return files.select("page", F.posexplode(F.split("value", "\n", -1)).alias("p", "line")).select("page", (F.col("p") + 1).alias("line_no"), F.rtrim("line").alias("line"))


def sidecar(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON sidecar files under a stated schema; a broken file comes out as a row whose _corrupt holds its text."""
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
    return (reader.option("columnNameOfCorruptRecord", "_corrupt") if "_corrupt" in schema else reader).json(path)


def findings(spark: SparkSession, path: str) -> DataFrame:
    """Findings, one JSON object a line."""
    return spark.read.schema(FINDING).json(path)


def page_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Hand-written pages like job/page_overrides/page_012.md: job_id, page, text; blank files override nothing."""
    files = spark.read.text(path, wholetext=True)
    where = F.input_file_name()
    return files.select(
        F.regexp_extract(where, r"([^/]+)/page_overrides/[^/]+$", 1).alias("job_id"),
        F.regexp_extract(where, r"page_(\d+)\.md$", 1).try_cast("int").alias("page"), F.col("value").alias("text"),
    ).where(F.trim("text") != "")


def with_overrides(auto: DataFrame, overrides: DataFrame, on: list[str], text: str = "text") -> DataFrame:
    """auto pages with the overriding text where there is one, and where each text comes from."""
    over = overrides.select(*on, F.col(text).alias("_o"))
    origin = F.when(F.col("_o").isNotNull(), "override").when(F.col(text).isNotNull(), "auto").otherwise("none")
    return auto.join(over, on, "left").withColumn("origin", origin).withColumn(text, F.coalesce("_o", text)).drop("_o")


def layout_pages(spark: SparkSession, path: str) -> DataFrame:
    """Layout pages exported by a document reader, one JSON object a page."""
    return spark.read.schema(LAYOUT).json(path)


def layout_lines(pages: DataFrame) -> DataFrame:
    """Line rows of layout pages: doc_id, page, line_no, box, direction, spans, text."""
    rows = pages.select("doc_id", "page", "height", F.posexplode("lines").alias("p", "l"))
    text = F.array_join(F.transform("l.spans", lambda s: F.coalesce(s["text"], F.lit(""))), "")
    return rows.select("doc_id", "page", "height", (F.col("p") + 1).alias("line_no"), "l.*", text.alias("text"))


def drawing_rules(pages: DataFrame) -> DataFrame:
    """Long horizontal and vertical rules of each page: doc_id, page, n_drawings, h_rules, v_rules."""
    w, h = (lambda d: F.abs(d["x1"] - d["x0"])), (lambda d: F.abs(d["y1"] - d["y0"]))
    none = F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double,fill:array<double>>>")
    d = F.coalesce("drawings", none)
    return pages.select(
        "doc_id", "page", F.size(d).alias("n_drawings"),
        F.size(F.filter(d, lambda x: (w(x) > h(x) * 3) & (w(x) > 50))).alias("h_rules"),
        F.size(F.filter(d, lambda x: (h(x) > w(x) * 3) & (h(x) > 50))).alias("v_rules"),
    )


def page_tables(pages: DataFrame) -> DataFrame:
    """Tables of each page from the top: doc_id, page, table_index, bbox, rows."""
    ordered = F.array_sort(F.transform("tables", lambda t: F.struct(t["bbox"][1].alias("y"), t["bbox"].alias("bbox"), t["rows"].alias("rows"))))
    return pages.select("doc_id", "page", F.posexplode(ordered).alias("table_index", "t")).select("doc_id", "page", "table_index", "t.bbox", "t.rows")


def page_links(pages: DataFrame) -> DataFrame:
    """Web links of each page with their anchor texts joined in reading order: doc_id, page, uri, anchor."""
    one = pages.select("doc_id", "page", F.explode("links").alias("l")).where(F.col("l.uri").rlike("^https?://"))
    parts = F.array_sort(F.collect_list(F.struct("l.y0", "l.x0", "l.anchor")))
    return one.groupBy("doc_id", "page", F.col("l.uri").alias("uri")).agg(F.array_join(F.transform(parts, lambda x: F.trim(x["anchor"])), " ").alias("anchor"))


def page_rotation(pages: DataFrame) -> DataFrame:
    """Orientation of each page by the direction of its lines: doc_id, page, orientation."""
    turned = F.filter("lines", lambda x: F.abs(F.coalesce(x["dir_y"], F.lit(0.0))) > 0.3)
    first = F.try_element_at(turned, F.lit(1))["dir_y"]
    return pages.select("doc_id", "page", F.when(first.isNull(), "normal").when(first > 0, "rotated_270").otherwise("rotated_90").alias("orientation"))


BEST = T.StructType([T.StructField("angle", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType())])


def best_rotation(readings: DataFrame) -> DataFrame:
    """Of the readings of a page at several angles (doc_id, page, angle, text) the one that reads best; ties keep the smallest angle."""
    from ..functions.text import english_score

    best = F.max(F.struct(F.coalesce(english_score(F.col("text")), F.lit(0.0)).alias("score"), (-F.col("angle")).alias("a"), "text")).alias("b")
    return readings.groupBy("doc_id", "page").agg(best).select("doc_id", "page", (-F.col("b.a")).alias("angle"), "b.text", "b.score")
