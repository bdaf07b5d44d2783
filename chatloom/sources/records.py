"""Sessions, samples, runs, comparisons and small stores: readers and writers of JSON lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import iso
from ..schemas import COMPARISON, GENERATION, RUN, SAMPLE, SESSION


def read_jsonl(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """Blank lines are skipped; a malformed one fails, or is dropped with mode DROPMALFORMED."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines (``_corrupt_record``) that are no JSON object or don't fit the schema."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    read = F.from_json("value", f"{schema}, _corrupt_record STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # As an element that is exploded the whole struct is read; Spark would else read the marks of bad lines alone, which it refuses to do.
    both = lines.select("value", F.explode(F.array(read)).alias("r"))
    bad = _malformed("value") | F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    return both.filter(~bad).select("r.*").drop("_corrupt_record"), both.filter(bad).select(F.col("value").alias("_corrupt_record"))


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; the first malformed line of a file is an error that names file and line.

    Lines are checked in one pass; only files that have a bad one are looked at again for its number.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path")).filter(F.trim("value") != "")
    bad = text.filter(_malformed("value")).agg(F.min("path").alias("path")).head()["path"]
    if bad is not None:
        lines = spark.read.text(bad, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("at", "value"))
        at = lines.filter((F.trim("value") != "") & _malformed("value")).agg(F.min("at").alias("at")).head()["at"]
        raise ValueError(f"{bad}:{at + 1}: not a JSON object")
    return read_jsonl(spark, path, schema)


def _malformed(c: str) -> Column:
    """Whether a line isn't a JSON object."""
    return F.from_json(F.col(c), "map<string,string>", {"mode": "PERMISSIVE"}).isNull() | ~F.ltrim(c).startswith("{")


def head_rows(spark: SparkSession, path: str, schema: str, n: int) -> DataFrame:
    """The first n good rows, by file and place in it."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line"))
    good = rows.filter((F.trim("value") != "") & ~_malformed("value")).orderBy("path", "line").limit(n)
    return good.select("path", "line", F.from_json("value", schema).alias("r")).orderBy("path", "line").select("r.*")


def repaired_ts(x) -> Column:
    """A time of a record; ``2022)12-...`` is read as ``2022-12-...``."""
    fixed = F.regexp_replace(x, r"^(\d{4})\)", "$1-")
    return F.coalesce(F.try_to_timestamp(x), F.to_timestamp(fixed))


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Turns of a sessions file: a row a turn."""
    return turns_of(read_jsonl(spark, path, SESSION))


def turns_of(sessions: DataFrame) -> DataFrame:
    rows = sessions.select("folder", "session_id", F.posexplode("turns").alias("turn_idx", "t"))
    return rows.select("folder", "session_id", "turn_idx", "t.author_id", "t.author_name", repaired_ts(F.col("t.start_ts")).alias("start_ts"), repaired_ts(F.col("t.end_ts")).alias("end_ts"), "t.text", "t.source_ids")


def session_records(turns: DataFrame) -> DataFrame:
    """Turns to session records, nested only here."""
    turn = F.struct("turn_idx", "author_id", "author_name", iso(F.col("start_ts")).alias("start_ts"), iso(F.col("end_ts")).alias("end_ts"), "text", "source_ids")
    rows = turns.groupBy("folder", "session_id").agg(F.min("start_ts").alias("f"), F.max("end_ts").alias("l"), F.sort_array(F.collect_set("author_id")).alias("authors"), F.array_sort(F.collect_list(turn)).alias("turns"))
    cut = F.transform("turns", lambda t: F.struct(*[t[c].alias(c) for c in ("author_id", "author_name", "start_ts", "end_ts", "text", "source_ids")]))
    return rows.select("session_id", "folder", iso(F.col("f")).alias("first_ts"), iso(F.col("l")).alias("last_ts"), "authors", cut.alias("turns"))


def message_records(messages: DataFrame) -> DataFrame:
    """Times as ISO text."""
    return messages.withColumns({"ts": iso(F.col("ts")), "edited_ts": iso(F.col("edited_ts"))})


def write_by_folder(messages: DataFrame, out: str, fmt: str = "parquet") -> DataFrame:
    """A partition a folder; returns counts by folder."""
    if fmt not in ("parquet", "jsonl"):
        raise ValueError(f"unknown format {fmt!r}")
    writer = message_records(messages).write.mode("overwrite").partitionBy("folder")
    writer.parquet(out) if fmt == "parquet" else writer.json(out)
    # What was written is counted, from the folders' names and the files' numbers of rows.
    spark = messages.sparkSession
    back = spark.read.parquet(out) if fmt == "parquet" else spark.read.text(out)
    return back.select(F.col("folder").cast("string").alias("folder")).groupBy("folder").count()


def write_jsonl(df: DataFrame, path: str, order: list | None = None, one_file: bool = False, mode: str = "overwrite") -> None:
    """JSON lines in the given order. Files follow each other in name order; ``one_file`` is for small results."""
    rows = df.orderBy(*order) if order else df
    (rows.coalesce(1) if one_file else rows).write.mode(mode).json(path)


def append_checkpoint(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, SAMPLE)


def read_generations(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, GENERATION)


def read_generations_checked(spark: SparkSession, path: str) -> tuple[DataFrame, str | None]:
    """Rows and no error, or no row and the first error."""
    try:
        return read_strict(spark, path, GENERATION), None
    except (ValueError, AnalysisException) as e:
        return spark.createDataFrame([], GENERATION), str(e).split("\n")[0]


def read_generations_lenient(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Good rows with their file's path."""
    return spark.read.schema(GENERATION).option("mode", "DROPMALFORMED").json(paths).select("*", F.col("_metadata.file_path").alias("path"))


def write_generations(rows: DataFrame, path: str) -> None:
    """A dump of generations, in order of ``place`` if there is one."""
    names = [f.name for f in _parsed(GENERATION)]
    order = ["place"] if "place" in rows.columns else None
    kept = rows.select(*[c for c in rows.columns if c in names or c == "place"])
    write_jsonl(kept.orderBy(*order).drop("place") if order else kept, path)


def _parsed(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).fields


def read_comparisons(spark: SparkSession, path: str) -> DataFrame:
    """Lenient, with file, its time and the row's place in it; no row where there is no file."""
    from .stores import Files

    files = Files(spark)
    if "*" not in path and not files.is_file(path) and not files.is_dir(path):
        return spark.createDataFrame([], f"{COMPARISON}, path STRING, mtime TIMESTAMP, line BIGINT")
    base = spark.read.schema(COMPARISON).option("mode", "DROPMALFORMED").json(path)
    return base.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("mtime"), F.monotonically_increasing_id().alias("line"))


def ok_comparisons(rows: DataFrame) -> DataFrame:
    """Without error rows and rows that lack a label."""
    named = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return rows.filter((F.coalesce("checkpoint_kind", F.lit("")) != "error") & named("winner_label") & named("loser_label"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run documents; unreadable ones are dropped. Scores may be nested by one level, whose keys are joined by a point; what isn't a number is left out."""
    raw = spark.read.schema(RUN).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    return raw.withColumn("scores", flat_score_map(F.col("scores")))


def flat_score_map(scores) -> Column:
    """A map of numbers from a map of JSON values: numbers, booleans as 1 and 0, and one level of objects."""
    inner = lambda v: F.from_json(v, "map<string,string>")
    number = lambda x: F.when(x == "true", F.lit(1.0)).when(x == "false", F.lit(0.0)).otherwise(F.when(x.rlike(r"^-?[0-9]"), x.try_cast("double")))
    is_object = lambda v: F.ltrim(v).startswith("{")
    own = F.transform(F.map_entries(F.map_filter(scores, lambda k, v: ~is_object(v))), lambda e: F.struct(e["key"].alias("key"), number(e["value"]).alias("value")))
    deep = F.flatten(F.transform(F.map_entries(F.map_filter(scores, lambda k, v: is_object(v))), lambda e: F.transform(F.map_entries(inner(e["value"])), lambda x: F.struct(F.concat(e["key"], F.lit("."), x["key"]).alias("key"), number(x["value"]).alias("value")))))
    return F.map_from_entries(F.filter(F.concat(F.coalesce(own, F.array().cast("array<struct<key:string,value:double>>")), F.coalesce(deep, F.array().cast("array<struct<key:string,value:double>>"))), lambda e: e["value"].isNotNull()))


def list_runs(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "created_utc", "label", F.col("model.name_or_path").alias("model"), F.coalesce(F.size("scores"), F.lit(0)).alias("n_scores"), F.col("persona.generations_path").alias("generations_path")).orderBy("created_utc", "run_id")


def flatten_results(documents: DataFrame, column: str = "value") -> DataFrame:
    """(task.metric, score) of results documents: numbers alone, without alias and samples; commas become points."""
    tasks = documents.select(F.explode(F.from_json(F.get_json_object(column, "$.results"), "map<string,map<string,string>>")).alias("task", "metrics"))
    rows = tasks.select("task", F.explode("metrics").alias("metric", "raw")).filter(~F.col("metric").isin("alias", "samples"))
    name = F.concat("task", F.lit("."), F.replace(F.replace("metric", F.lit(","), F.lit(".")), F.lit(" "), F.lit("")))
    return rows.select(name.alias("metric"), F.expr("try_cast(raw AS DOUBLE)").alias("score")).filter("score is not null")


def newest_results(spark: SparkSession, root: str) -> DataFrame:
    """The newest results document below a folder."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    files = files.select("value", F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_modification_time").alias("mtime"))
    mine = (F.col("name").startswith("results") | F.col("name").endswith("_results.json")) & ~F.col("name").contains("_samples_")
    return files.filter(mine).agg(F.max_by(F.struct("value", "name"), F.struct("mtime", "name")).alias("f")).select("f.*")


def store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small stored table; an absent one is empty."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with their keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def file_hash(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Stripped lines that aren't blank."""
    from ..functions.text import strip

    return spark.read.text(path).select(strip(F.col("value")).alias("line")).filter("line <> ''")
