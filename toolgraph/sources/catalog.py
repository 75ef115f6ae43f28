"""Tool catalogues from JSON lines, and other row sources with their rules for bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from toolgraph.functions.hashing import skeleton_id
from toolgraph.functions.text import strip, valid_json
from toolgraph.scratch import materialize

PARAMETERS = "struct<type:string,properties:map<string,variant>,required:array<string>>"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, line) of text files; ``ord`` grows along a file. A missing path raises."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line"))


def tool_entries(lines: DataFrame, unpack: bool = True, observation: Observation | None = None) -> DataFrame:
    """(ord, pos, n, name, description, parameters, sound): the tools of each JSON line, before dedup.

    A string ``tools`` is a JSON array of tools, otherwise the row is the tool; each may stand in a ``function``
    envelope. Absent description and parameters become empty, but a null one makes the entry unsound, as does no name.
    Lines that are no JSON, or whose ``tools`` text is none, have no entries. Without ``unpack`` every row is a tool. ``observation`` gets the counts lines, blank and unreadable.
    """
    row = F.try_parse_json(valid_json("line"))
    packed = F.try_variant_get("row", "$.tools", "string")
    is_packed = F.coalesce(F.schema_of_variant(F.try_variant_get("row", "$.tools", "variant")) == "STRING", F.lit(False))
    listed = F.when(is_packed & F.lit(unpack), F.try_parse_json(valid_json(packed)).try_cast("array<variant>")).otherwise(F.array("row"))
    rows = lines.withColumn("row", row)
    if observation:
        blank = F.trim("line") == ""
        rows = rows.observe(observation, F.count(F.lit(1)).alias("lines"), F.count_if(blank).alias("blank"), F.count_if(~blank & F.col("row").isNull()).alias("unreadable"))
    rows = rows.filter("row IS NOT NULL").withColumn("list", listed)
    found = rows.select("ord", F.size("list").alias("n"), F.posexplode("list").alias("pos", "entry"))
    body = F.coalesce(F.try_variant_get("entry", "$.function", "variant"), F.col("entry"))
    found = found.withColumn("body", body)
    get = lambda key, kind: F.try_variant_get("body", f"$.{key}", kind)
    absent = lambda key: get(key, "variant").isNull()
    text = lambda key: F.when(F.schema_of_variant(get(key, "variant")) == "STRING", get(key, "string"))
    entry = found.select(
        "ord", "pos", "n", text("name").alias("name"),
        F.when(absent("description"), F.lit("")).otherwise(text("description")).alias("description"),
        F.struct(
            F.coalesce(get("parameters.type", "string"), F.lit("object")).alias("type"),
            F.coalesce(get("parameters.properties", "map<string,variant>"), F.expr("CAST(map() AS map<string,variant>)")).alias("properties"),
            F.coalesce(get("parameters.required", "array<string>"), F.array().cast("array<string>")).alias("required"),
        ).cast(PARAMETERS).alias("parameters"),
        (absent("parameters") | F.coalesce(F.schema_of_variant(get("parameters", "variant")).startswith("OBJECT"), F.lit(False))).alias("whole"),
    )
    return entry.withColumn("sound", F.col("name").isNotNull() & F.col("description").isNotNull() & F.col("whole")).drop("whole")


def catalog(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ord, name, description, parameters, category) with the first definition of each name, and the lines that were counted.

    Within a line, tools up to the first unsound one register; a line with an unsound tool is not counted. Every tool
    starts in the category ``general``.
    """
    return catalog_of(tool_entries(lines))


def load_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, int]]:
    """The tools of :func:`catalog` in the files at ``path``, and what the load saw: lines, blank, unreadable, records (lines that were counted), tools.

    Files are read and parsed once; lines are counted in that pass.
    """
    seen = Observation("load")
    entries = materialize(tool_entries(numbered_lines(spark, path), observation=seen), "tool-entries")
    tools, counted = catalog_of(entries)
    tools = materialize(tools, "tools")
    return tools, seen.get | {"records": counted.filter("counted").count(), "tools": tools.count()}


def catalog_of(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`catalog` of what :func:`tool_entries` found."""
    broken = entries.filter("NOT sound").groupBy("ord").agg(F.min("pos").alias("bad"))
    usable = entries.join(broken, "ord", "left").filter("bad IS NULL OR pos < bad")
    first = usable.groupBy("name").agg(F.min_by(F.struct("ord", "pos", "description", "parameters"), F.struct("ord", "pos")).alias("t"))
    tools = first.select(F.col("t.ord").alias("ord"), F.col("t.pos").alias("pos"), "name", "t.description", "t.parameters", F.lit("general").alias("category"))
    counted = entries.groupBy("ord").agg(F.every("sound").alias("counted"))
    return tools, counted


def tool_map(lines: DataFrame) -> DataFrame:
    """(name, description, parameters): the last definition of each name; no packed rows, every line must be a tool."""
    entries = tool_entries(lines, unpack=False).filter("name IS NOT NULL")
    return entries.groupBy("name").agg(F.max_by(F.struct("description", "parameters"), "ord").alias("t")).select("name", "t.*")


def producer_texts(tools: DataFrame) -> DataFrame:
    return tools.select(F.col("name").alias("producer"), F.concat("name", F.lit(": "), "description").alias("text"))


def consumer_texts(tools: DataFrame) -> DataFrame:
    """One row a parameter: ``Parameter <name>: <description>``."""
    said = F.coalesce(F.try_variant_get("schema", "$.description", "string"), F.lit(""))
    return tools.select(F.col("name").alias("consumer"), F.explode("parameters.properties").alias("param", "schema")).select("consumer", "param", F.concat(F.lit("Parameter "), "param", F.lit(": "), said).alias("text"))


def json_rows(spark: SparkSession, path: str, schema: str | None = None, list_only: bool = False) -> DataFrame:
    """Rows of a JSON array or of JSON lines, found out by the first character; bad lines are dropped. ``list_only``: anything but an array raises."""
    head = spark.read.text(path).filter(F.trim("value") != "").select(F.substring(F.trim("value"), 1, 1).alias("c")).first()
    if list_only and not (head and head["c"] == "["):
        raise ValueError(f"{path} holds no JSON array")
    reader = spark.read.option("mode", "DROPMALFORMED")
    reader = reader.schema(schema) if schema else reader
    return reader.option("multiLine", bool(head and head["c"] == "[")).json(path)


def skeletons_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All skeletons of a JSON array, or no rows at all if one of them is bad."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").option("multiLine", True).json(path)
    bad = rows.agg(F.max(F.col("_corrupt_record").isNotNull()).alias("bad")).first()["bad"]
    return rows.drop("_corrupt_record").filter(F.lit(not bad))


def skeleton_map(rows: DataFrame) -> DataFrame:
    """``rows`` (edges, perhaps id) with ``skeleton_id``: their own id, or else their fingerprint; of equal ids the last row in file order stays.

    Rows without edges are bad and fall out.
    """
    own = F.col("id").cast("string") if "id" in rows.columns else F.lit(None).cast("string")
    keyed = rows.filter("edges IS NOT NULL").withColumn("skeleton_id", F.coalesce(own, skeleton_id("edges"))).withColumn("__ord", F.monotonically_increasing_id())
    return last_of_each(keyed, "skeleton_id", "__ord").drop("__ord")


def done_list(spark: SparkSession, path: str, key: str = "subset") -> DataFrame:
    """Distinct trimmed lines; empty if there is no such file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], f"{key} string")
    return spark.read.text(path).select(strip("value").alias(key)).filter(F.col(key) != "").distinct()


def text_files(spark: SparkSession, path: str, extensions: list[str] | None = None, ignored_dirs: list[str] = (), ignored_extensions: list[str] = ()) -> DataFrame:
    """(path, text) of UTF-8 files with one of the extensions (any case; None: of any that is not ignored), outside the ignored directories."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ending = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    kept = files if extensions is None else files.filter(ending.isin([e.lower() for e in extensions]))
    kept = kept.filter(~ending.isin([e.lower() for e in ignored_extensions]))
    for d in ignored_dirs:
        kept = kept.filter(~F.contains("path", F.lit(f"/{d}/")))
    return kept.filter(F.is_valid_utf8("content")).select("path", F.decode("content", "UTF-8").alias("text"))


def last_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    return rows.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")
