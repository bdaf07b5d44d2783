"""Small documents beside the data: run documents, ratings, verdicts, annotations, dumps and probes.

Documents are JSON of some kilobytes, one a file, as other tools of the workspace keep
them. They are read and written whole on the driver, through Hadoop's file systems, so any
store that Spark reaches will do; what is computed from them are frames.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import sample_key
from ..operators import merge

RATING = "gkey STRING, label STRING, rating DOUBLE, win_rate DOUBLE, updated_utc STRING"
VERDICT = "comparison STRING, sample_key STRING, variant_id STRING, verdict STRING"
ANNOTATION = "run_id STRING, alias STRING, notes STRING"
DUMP = "run_id STRING, label STRING, path STRING, created_utc STRING, eval_val_sha256 STRING, eval_val_jsonl STRING, manifest STRING"


class Files:
    """Whole small files of any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def is_file(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isFile()

    def is_dir(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def size(self, path: str) -> int:
        fs, p = self._at(path)
        return fs.getFileStatus(p).getLen()

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if self.is_dir(path) else []

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The file is there whole or not at all: it is written beside its place and then moved over it."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        temp = self.jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(temp, True)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        how[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri() if p.toUri().getScheme() else fs.getUri(), self.conf).rename(fs.makeQualified(temp), fs.makeQualified(p), how)

    def document(self, path: str, default: dict | None = None) -> dict | None:
        """A JSON object; the default if there is none or it can't be read."""
        try:
            found = json.loads(self.read(path)) if self.is_file(path) else default
        except ValueError:
            return default
        return found if isinstance(found, dict) else default


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def stamp() -> str:
    """A time for names of files and runs."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H-%M-%SZ")


def runs_dir(out: str) -> str:
    return f"{out.rstrip('/')}/runs"


def raw_dir(out: str) -> str:
    return f"{out.rstrip('/')}/raw"


# -- runs --------------------------------------------------------------------------------------------------


def save_run(spark: SparkSession, run: dict, out: str) -> str:
    """Write ``<out>/runs/<run_id>.json``; a run without id is an error."""
    if not run.get("run_id"):
        raise ValueError("a run needs a run_id")
    path = f"{runs_dir(out)}/{run['run_id']}.json"
    Files(spark).write(path, json.dumps(run, indent=2, ensure_ascii=False) + "\n")
    return path


def resolve_runs(spark: SparkSession, refs: list[str], out: str | None = None) -> list[str]:
    """Paths of runs that are given as paths or as ids under ``<out>/runs``."""
    files, found = Files(spark), []
    for ref in refs:
        tried = [ref] + ([f"{runs_dir(out)}/{ref}.json"] if out else [])
        path = next((p for p in tried if files.is_file(p)), None)
        if path is None:
            raise FileNotFoundError(f"no run {ref!r}; tried {tried}")
        found.append(path)
    return found


def load_run(spark: SparkSession, ref: str, out: str | None = None) -> dict:
    return json.loads(Files(spark).read(resolve_runs(spark, [ref], out)[0]))


# -- ratings, verdicts, annotations ------------------------------------------------------------------------


def _number(x) -> float | None:
    try:
        return None if x is None else float(x)
    except (TypeError, ValueError):
        return None


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Rows (gkey, label, rating, win_rate, updated_utc) of a store ``{"groups": {key: {"elo": {...}, "win_rate": {...}}}}``; ratings that aren't numbers are left out."""
    rows = []
    groups = (Files(spark).document(path, {}) or {}).get("groups")
    for key, g in (groups if isinstance(groups, dict) else {}).items():
        if isinstance(g, dict) and isinstance(g.get("elo"), dict):
            rates = g.get("win_rate") if isinstance(g.get("win_rate"), dict) else {}
            rows += [(key, label, _number(r), _number(rates.get(label)), str(g.get("updated_utc") or "")) for label, r in g["elo"].items() if _number(r) is not None]
    return spark.createDataFrame(rows, RATING)


def write_ratings(spark: SparkSession, ratings: DataFrame, path: str) -> None:
    """The store of the rows, whole. It has a rating a run and group, which is small."""
    groups: dict = {}
    for r in ratings.orderBy("gkey", F.col("rating").desc(), "label").collect():
        g = groups.setdefault(r["gkey"], {"updated_utc": r["updated_utc"], "elo": {}, "win_rate": {}, "ranked_run_ids": []})
        g["elo"][r["label"]], g["win_rate"][r["label"]] = r["rating"], r["win_rate"]
        g["ranked_run_ids"] = sorted([*g["ranked_run_ids"], r["label"]])
    Files(spark).write(path, json.dumps({"version": 1, "groups": groups}, indent=2, ensure_ascii=False) + "\n")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """Rows (comparison, sample_key, variant_id, verdict) of a store of verdicts; of older ones, with one vote a sample, the vote counts as accepted."""
    rows = []
    found = (Files(spark).document(path, {}) or {}).get("comparisons")
    for key, block in (found if isinstance(found, dict) else {}).items():
        for sample, own in (block.get("verdicts") or {}).items() if isinstance(block, dict) else ():
            rows += [(key, sample, variant, kind) for variant, kind in (own or {}).items()]
        given = {(s, v) for c, s, v, _ in rows if c == key}
        for sample, variant in (block.get("votes") or {}).items() if isinstance(block, dict) else ():
            if isinstance(variant, str) and (sample, variant) not in given:
                rows.append((key, sample, variant, "accepted"))
    return spark.createDataFrame(rows, VERDICT)


def write_verdicts(spark: SparkSession, verdicts: DataFrame, path: str) -> None:
    out: dict = {}
    for r in verdicts.orderBy("comparison", "sample_key", "variant_id").collect():
        out.setdefault(r["comparison"], {"verdicts": {}, "variants": {}})["verdicts"].setdefault(r["sample_key"], {})[r["variant_id"]] = r["verdict"]
    Files(spark).write(path, json.dumps({"version": 1, "comparisons": out}, indent=2, ensure_ascii=False) + "\n")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Rows (run_id, alias, notes), stripped."""
    runs = (Files(spark).document(path, {}) or {}).get("runs")
    text = lambda x: str(x or "").strip()
    return spark.createDataFrame([(k, text(v.get("alias")), text(v.get("notes"))) for k, v in (runs if isinstance(runs, dict) else {}).items() if isinstance(v, dict)], ANNOTATION)


def write_annotations(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Rows without run are left out."""
    text = lambda x: (x or "").strip()
    runs = {r["run_id"].strip(): {"alias": text(r["alias"]), "notes": text(r["notes"])} for r in rows.filter("trim(coalesce(run_id, '')) <> ''").orderBy("run_id").collect()}
    Files(spark).write(path, json.dumps({"version": 1, "runs": runs}, indent=2, ensure_ascii=False) + "\n")


def annotated(runs: DataFrame, annotations: DataFrame) -> DataFrame:
    """Runs with alias and notes, empty where there are none."""
    a = annotations.select("run_id", F.trim("alias").alias("alias"), F.trim("notes").alias("notes"))
    empty = {c: F.coalesce(c, F.lit("")) for c in ("alias", "notes")}
    return runs.join(a, "run_id", "left").withColumns(empty)


# -- dumps of generations ----------------------------------------------------------------------------------


def _first_fields(spark: SparkSession, path: str) -> tuple[str, str]:
    """eval_val_sha256 and eval_val_jsonl of the first good row of a dump."""
    from .records import head_rows

    r = head_rows(spark, path, "eval_val_sha256 STRING, eval_val_jsonl STRING", 1).head()
    return (r["eval_val_sha256"], r["eval_val_jsonl"]) if r else (None, None)


def saved_dumps(spark: SparkSession, root: str) -> DataFrame:
    """DUMP rows of the runs under ``root`` whose ``persona.generations_path`` is a file."""
    files, rows = Files(spark), []
    folder = runs_dir(root) if files.is_dir(runs_dir(root)) else root
    for name in files.names(folder):
        run = files.document(f"{folder}/{name}") if name.endswith(".json") else None
        path = ((run or {}).get("persona") or {}).get("generations_path")
        if path and files.is_file(path):
            sha, val = _first_fields(spark, path)
            run_id = str(run.get("run_id") or name.removesuffix(".json"))
            rows.append((run_id, str(run.get("label") or run_id), path, str(run.get("created_utc") or ""), sha, val, str((run.get("config") or {}).get("val_jsonl") or "")))
    return spark.createDataFrame(rows, DUMP)


def listed_dumps(spark: SparkSession, paths: list[str], runs: list[str | None] | None = None) -> DataFrame:
    """DUMP rows of given files, with run documents where they are given and can be read; else the run is named by its folder. Files that aren't there are left out."""
    files, rows = Files(spark), []
    for i, path in enumerate(p.strip() for p in paths):
        if not path or not files.is_file(path):
            continue
        ref = runs[i] if runs and i < len(runs) else None
        run = (files.document(ref) if ref else None) or {}
        sha, val = _first_fields(spark, path)
        run_id = str(run.get("run_id") or path.rstrip("/").split("/")[-2])
        rows.append((run_id, str(run.get("label") or run_id), path, str(run.get("created_utc") or ""), sha, val, str((run.get("config") or {}).get("val_jsonl") or "")))
    return spark.createDataFrame(rows, DUMP)


def run_beside(spark: SparkSession, dump: str) -> str | None:
    """Of ``<root>/raw/<run>/<dump>`` the document ``<root>/runs/<run>.json``, if it is there."""
    parts = dump.rstrip("/").split("/")
    if len(parts) < 4 or parts[-3] != "raw":
        return None
    path = "/".join(parts[:-3]) + f"/runs/{parts[-2]}.json"
    return path if Files(spark).is_file(path) else None


def grouped_dumps(spark: SparkSession, dumps: DataFrame) -> DataFrame:
    """Dumps with ``n`` (rows), ``fingerprint`` and ``gkey``, the key of what they can be compared with. All dumps are read in one scan."""
    from .records import read_generations_lenient

    paths = [r["path"] for r in dumps.select("path").distinct().collect()]
    if not paths:
        return dumps.selectExpr("*", "0L AS n", "'' AS fingerprint", "'' AS gkey")
    rows = read_generations_lenient(spark, paths)
    keyed = rows.select(F.col("path").alias("source"), sample_key(F.col("persona_id"), F.col("context_turns"), F.col("reference")).alias("key"))
    prints = merge.slice_fingerprint(keyed).withColumnRenamed("source", "found")
    same = F.regexp_replace("found", "^file:/*", "/") == F.regexp_replace("path", "^file:/*", "/")
    j = dumps.join(prints, same, "left").drop("found").withColumns({"n": F.coalesce("n", F.lit(0)), "fingerprint": F.coalesce("fingerprint", F.lit(""))})
    key = merge.compat_key(F.col("eval_val_sha256"), F.col("eval_val_jsonl"), F.col("fingerprint"), F.col("manifest"), F.col("path"))
    return j.withColumn("gkey", key)


def groups(dumps: DataFrame) -> DataFrame:
    """(gkey, members, runs, title) of dumps with a gkey, by key; members are run ids."""
    g = dumps.groupBy("gkey").agg(F.array_sort(F.collect_set("run_id")).alias("members"), F.count("*").alias("runs"))
    return merge.group_title(g).orderBy("gkey")


# -- reports, profiles, probes -----------------------------------------------------------------------------


def save_report(spark: SparkSession, report: dict, path: str) -> None:
    Files(spark).write(path, json.dumps(report, indent=2, ensure_ascii=False, default=str) + "\n")


def load_report(spark: SparkSession, path: str) -> dict | None:
    return Files(spark).document(path)


def save_profiles(spark: SparkSession, profiles: DataFrame, path: str) -> int:
    """``{"personas": {id: profile}}``; returns how many. A profile is some kilobytes, and there is one a persona."""
    found = {r["persona_id"]: r.asDict(recursive=True) for r in profiles.orderBy("persona_id").toLocalIterator()}
    for p in found.values():
        p.pop("persona_id")
    Files(spark).write(path, json.dumps({"personas": found}, indent=2, ensure_ascii=False) + "\n")
    return len(found)


PROFILE = """STRUCT<length:STRUCT<n:BIGINT,mean_words:DOUBLE,p50:INT,p95:INT>,lowercase_start_rate:DOUBLE,emoji:STRUCT<unicode_per_turn:DOUBLE,custom_per_turn:DOUBLE>,
burst_size:DOUBLE,burst_rate:DOUBLE,top_fillers:STRUCT<`1gram`:ARRAY<STRUCT<token:STRING,z:DOUBLE,count:BIGINT>>,`2gram`:ARRAY<STRUCT<token:STRING,z:DOUBLE,count:BIGINT>>,`3gram`:ARRAY<STRUCT<token:STRING,z:DOUBLE,count:BIGINT>>>>"""


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles as ``build_profiles`` returns them; what a document lacks is null."""
    doc = spark.read.schema(f"personas MAP<STRING,{PROFILE}>").option("multiLine", True).json(path)
    return doc.select(F.explode("personas").alias("persona_id", "p")).select("persona_id", "p.*")


def probes(spark: SparkSession, path: str) -> DataFrame:
    """(path, label, value): gradient probes, a file or all ``gradient_norms*.json`` below a folder, with their labels."""
    r = spark.read.option("recursiveFileLookup", True)
    r = r if Files(spark).is_file(path) else r.option("pathGlobFilter", "gradient_norms*.json")
    rows = r.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.withColumn("label", probe_label(F.col("path"), F.col("value"))).orderBy("path")


def probe_label(path, value):
    """The configuration's name (else the folder's, of a file named gradient_norms, else the file's), and rank and alpha of the adapter."""
    stem = lambda x: F.regexp_replace(F.substring_index(x, "/", -1), r"(?<=.)\.[^.]*$", "")
    own, folder = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    config = F.nullif(F.get_json_object(value, "$.config_path"), F.lit(""))
    base = F.coalesce(stem(config), F.when(own.startswith("gradient_norms"), folder).otherwise(stem(path)))
    part = lambda letter, key: F.concat(F.lit(letter), F.get_json_object(value, f"$.lora.{key}"))
    return F.concat_ws("-", base, part("r", "r"), part("a", "alpha"))
