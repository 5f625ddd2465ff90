"""Versioned parquet collections: upsert, delete, statistics.

A collection is a folder of segments, each a parquet directory partitioned by namespace, and one small commit
file per version that says which namespaces of which segments are live. Commit files are created once and never
changed, so a writer that loses a race fails, a job that dies leaves the last version as it was, and readers
keep the version they opened. Deletes are commits only; an upsert rewrites only the files that hold replaced records,
and its commit file names those that are gone.

Records keep the sequence number of the change they come from, so the newest change of a record wins whatever the order
in which changes are brought in.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvec import model as M
from quillvec.functions.records import reject_reasons
from quillvec.functions.scalars import from_token, to_token
from quillvec.operators.generate import write_batches
from quillvec.storage import checkpointed, child_names, hadoop_path, read_text, sized, write_once

STORED = T.StructType([
    *M.RECORD_FIELDS,
    T.StructField("file", T.StringType()),
    T.StructField("reasons", T.ArrayType(T.StringType())),
    T.StructField("seq", T.LongType()),
])
PLACED = T.StructType([
    *STORED, T.StructField("segment", T.StringType()), T.StructField("kept", T.BooleanType()),
    T.StructField("namespace", T.StringType()),
])
MOST_PIECES = 32
#: How often an upsert starts again on a newer version when another writer was first.
ATTEMPTS = 5


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


@dataclass
class Version:
    number: int = 0
    dimension: int | None = None
    live: dict[str, list[str]] = field(default_factory=dict)  # segment -> namespace tokens
    applied: dict[str, int] = field(default_factory=dict)  # stream -> last batch
    gone: dict[str, dict[str, list[str]]] = field(default_factory=dict)  # segment -> namespace token -> rewritten files

    def tokens(self) -> set[str]:
        return {t for tokens in self.live.values() for t in tokens}


class Collection:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- versions ---------------------------------------------------------------------------------------------

    def version(self, number: int | None = None) -> Version:
        """A committed version, the newest by default; version 0 is the empty collection."""
        if number is None:
            number = max((int(n[:-5]) for n in child_names(self.spark, f"{self.root}/commits") if n.endswith(".json")),
                         default=0)
        if number == 0:
            return Version()
        return Version(**json.loads(read_text(self.spark, self._commit_path(number))))

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/commits/{number:010d}.json"

    def commit(self, base: Version, live: dict[str, list[str]], dimension: int | None = None,
               applied: dict[str, int] | None = None, gone: dict[str, dict[str, list[str]]] | None = None) -> Version:
        live = {s: sorted(t) for s, t in live.items() if t}
        gone = {s: {t: sorted(f) for t, f in found.items() if t in live.get(s, ())}
                for s, found in (base.gone if gone is None else gone).items()}
        new = Version(base.number + 1, dimension or base.dimension, live, {**base.applied, **(applied or {})},
                      {s: found for s, found in gone.items() if found})
        try:
            write_once(self.spark, self._commit_path(new.number), json.dumps(new.__dict__).encode())
        except Exception as err:
            if "FileAlreadyExists" in str(err):
                raise CommitConflict(f"version {new.number} exists") from err
            raise
        return new

    # -- segments ---------------------------------------------------------------------------------------------

    def segment_path(self, segment: str, kept: bool | None = None) -> str:
        path = f"{self.root}/segments/segment={segment}"
        return path if kept is None else f"{path}/kept={str(kept).lower()}"

    def new_segment(self) -> str:
        return uuid.uuid4().hex[:16]

    def write_segment(self, rows: DataFrame, segment: str) -> list[str]:
        """Write records with ``kept``; returns the namespace tokens of the kept ones.

        Tasks write the namespaces they hold. Rows are not moved here: a caller whose rows lie mixed
        rebalances them first.
        """
        for name, kind in (("file", "string"), ("reasons", "array<string>"), ("seq", "long")):
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast(kind))
        if "kept" not in rows.columns:
            rows = rows.withColumn("kept", F.lit(True))
        out = rows.select("id", "values", "sparse_values", "metadata", "file", "reasons", "seq", "kept",
                          to_token(F.col("namespace")).alias("namespace"))
        out.write.partitionBy("kept", "namespace").parquet(self.segment_path(segment))
        return self.segment_tokens(segment)

    def drop_segment(self, segment: str) -> None:
        """Remove a segment that no version refers to."""
        jpath, fs = hadoop_path(self.spark, self.segment_path(segment))
        fs.delete(jpath, True)

    def segment_tokens(self, segment: str) -> list[str]:
        folder = self.segment_path(segment, True)
        names = [n.split("=", 1)[1] for n in child_names(self.spark, folder) if n.startswith("namespace=")]
        return [self._names().unescapePathName(n) for n in names]

    def _names(self):
        """Spark's rule for partition values in directory names."""
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils

    def _scan(self, paths: list[str]) -> DataFrame:
        """Segment directories as one scan, with segment, kept and namespace token from the path."""
        if not paths:
            return self.spark.createDataFrame([], PLACED)
        return self.spark.read.schema(PLACED).option("basePath", f"{self.root}/segments").parquet(*paths)

    def stored_rows(self, segment: str) -> int:
        """Records that were kept when a segment was written, counted from its footers."""
        path = self.segment_path(segment, True)
        return self._scan([path] if child_names(self.spark, path) else []).count()

    def segment_files(self, segment: str) -> DataFrame:
        """Source files of a segment, one row per record."""
        return self._scan([self.segment_path(segment)]).select("file")

    # -- reading ----------------------------------------------------------------------------------------------

    def _live_rows(self, live: dict[str, list[str]], gone: dict[str, dict[str, list[str]]] | None = None,
                   placed: bool = False) -> DataFrame:
        """Rows of the given namespaces of segments, without the files that are gone; if ``placed``, with the ``place``
        of their file. Only the directories of these namespaces are listed, and files that are gone are not opened.
        """
        paths = []
        for segment, tokens in live.items():
            folder = self.segment_path(segment, True)
            if not tokens:
                continue
            if set(tokens) == set(self.segment_tokens(segment)):
                paths.append(folder)
            else:
                paths += [f"{folder}/namespace={self._names().escapePathName(t)}" for t in tokens]
        rows = self._scan(paths).withColumnRenamed("namespace", "token")
        if not paths:
            return rows.withColumn("place", F.lit(None).cast("string")) if placed else rows
        left_out = [f for s, tokens in live.items() for t in tokens for f in (gone or {}).get(s, {}).get(t, [])]
        # Comparisons with the path alone are made where files are listed. Its use costs the counts from footers alone.
        place = F.substring_index("_metadata.file_path", "/segments/segment=", -1)
        if placed:
            rows = rows.withColumn("place", place)
        return rows.filter(~(F.col("place") if placed else place).isin(left_out)) if left_out else rows

    def read(self, namespace: str | None = None, number: int | None = None) -> DataFrame:
        """Records of a version, of all namespaces or one."""
        version = self.version(number)
        live = version.live
        if namespace is not None:
            token = M.DEFAULT_TOKEN if namespace == M.DEFAULT_NAMESPACE else namespace
            live = {s: [token] for s, tokens in live.items() if token in tokens}
        return self._live_rows(live, version.gone).withColumn("namespace", from_token(F.col("token"))) \
            .select(*M.RECORD_COLUMNS)

    def rejected(self, segment: str) -> DataFrame:
        path = self.segment_path(segment, False)
        rows = self._scan([path] if child_names(self.spark, path) else [])
        return rows.select(from_token(F.col("namespace")).alias("namespace"), "id", "file", "reasons")

    # -- changes ----------------------------------------------------------------------------------------------

    def merge(self, base: Version, segment: str, tokens: list[str], dimension: int | None = None,
              applied: dict[str, int] | None = None) -> Version:
        """Commit a written segment over ``base``: its records replace those with the same namespace and id, unless
        those come from a change with a greater sequence number.

        Only ids and sequence numbers are compared. A file of an older segment is rewritten if it holds a replaced
        record, and a namespace as a whole if it has come to lie in very many segments; else the segments stay side by
        side. The new segment is written again only if some of its records are older than what the collection has.
        """
        touched = {s: sorted(set(t) & set(tokens)) for s, t in base.live.items()}
        touched = {s: t for s, t in touched.items() if t}
        live = {s: list(t) for s, t in base.live.items()}
        gone = {s: {t: list(f) for t, f in found.items()} for s, found in base.gone.items()}
        if touched:
            keys = self._keys(segment, tokens)
            met = self._live_rows(touched, base.gone, True).select("segment", "token", "place", "id", "seq") \
                .join(keys.withColumn("met", F.lit(True)), ["token", "id"], "left")
            # One row for each file of the namespaces in question.
            files = met.groupBy("segment", "token", "place").agg(
                F.count_if(F.col("met") & ~_older()).alias("replaced"), F.count_if(_older()).alias("older")).collect()
            if any(f.older for f in files):
                late = met.filter(_older()).select("token", "id")
                rest = self._live_rows({segment: tokens}).join(late, ["token", "id"], "left_anti")
                segment, tokens = self._rewritten(rest)
                keys = self._keys(segment, tokens)
            pieces = Counter(t for found in touched.values() for t in found)
            rewritten: dict[str, dict[str, list[str]]] = {}
            lying: dict[tuple[str, str], list] = {}
            for f in files:
                lying.setdefault((f.segment, f.token), []).append(f)
            for old, found in touched.items():
                for t in found:
                    mine = lying.get((old, t), [])
                    hit = [f.place for f in mine if f.replaced]
                    if len(hit) == len(mine) or pieces[t] >= MOST_PIECES:
                        rewritten.setdefault(old, {})[t] = [f.place for f in mine]
                        live[old].remove(t)
                    elif hit:
                        rewritten.setdefault(old, {})[t] = hit
                        gone.setdefault(old, {}).setdefault(t, []).extend(hit)
            if rewritten:
                places = [p for found in rewritten.values() for hit in found.values() for p in hit]
                rest = self._live_rows({s: sorted(t) for s, t in rewritten.items()}, placed=True) \
                    .filter(F.col("place").isin(places)) \
                    .join(keys.drop("new_seq"), ["token", "id"], "left_anti")
                kept, found = self._rewritten(rest)
                live[kept] = found
        live[segment] = tokens
        return self.commit(base, live, dimension, applied, gone)

    def _keys(self, segment: str, tokens: list[str]) -> DataFrame:
        return sized(self._live_rows({segment: tokens}).select("token", "id", F.col("seq").alias("new_seq")))

    def _rewritten(self, rows: DataFrame) -> tuple[str, list[str]]:
        """A new segment of stored rows, and its namespace tokens."""
        segment = self.new_segment()
        rows = rows.withColumn("namespace", from_token(F.col("token"))).select(*M.RECORD_COLUMNS, "file", "seq")
        return segment, self.write_segment(rows, segment)

    def upsert(self, changes: DataFrame, seq: str = "seq", stream: str | None = None, batch: int | None = None,
               dimension: int | None = None) -> Version:
        """Insert or replace records by namespace and id; the highest ``seq`` of a record wins.

        That holds over calls as well: a change older than what the collection has of its record does nothing. Of equal
        numbers the later call counts, and so does a change without a number. If another writer commits meanwhile, the
        written changes are merged into its version.

        With ``stream`` and ``batch``, a batch that was committed before is skipped. A record without namespace,
        id or values, or of another dimension than the collection's, fails the call and nothing is committed.
        """
        base = self.version()
        if stream is not None and base.applied.get(stream, -1) >= batch:
            return base
        segment, known = self.new_segment(), base.dimension or dimension
        complete = newest(_complete(changes, known), seq, keep=True).withColumn("seq", F.col(seq).cast("long"))
        tokens = self.write_segment(complete.hint("rebalance", "namespace"), segment)
        applied = {stream: batch} if stream is not None else None
        for attempt in range(ATTEMPTS):
            try:
                return self.merge(base, segment, tokens, known, applied)
            except CommitConflict:
                base = self.version()
                if attempt == ATTEMPTS - 1 or (known is not None and base.dimension not in (None, known)):
                    raise
                if stream is not None and base.applied.get(stream, -1) >= batch:
                    return base

    def upsert_batches(self, records: DataFrame, number: str, seq: str = "seq", size: int = M.BATCH_SIZE,
                       dimension: int | None = None) -> tuple[Version, DataFrame]:
        """Upsert in batches of ``size`` records, in the order of ``number``; a batch with a bad record fails alone.

        Returns the version and, for each batch, ``batch, n_rows, n_bad, success``. A record is bad as in an import, or if
        it has no namespace. All batches that are whole become one version; if none is, the version stays. Only
        the numbers of failed batches are sent around, and records are moved once, for the numbering.
        """
        base = self.version()
        known = base.dimension or dimension
        # Without a known dimension any length will do.
        length = F.lit(known) if known else F.size("values")
        broken = F.size(reject_reasons(length)) > 0
        placed = write_batches(records, number, size).withColumn("bad", broken | F.col("namespace").isNull())
        batches = checkpointed(placed.groupBy("batch").agg(
            F.count("*").alias("n_rows"), F.count_if("bad").alias("n_bad"))
            .withColumn("success", F.col("n_bad") == 0))
        if batches.filter("success").isEmpty():
            return base, batches
        failed = sized(batches.filter("NOT success").select("batch"))
        whole = placed.join(failed, "batch", "left_anti").drop("bad", "batch", "position")
        return self.upsert(whole, seq, dimension=dimension), batches

    def delete_namespace(self, namespace: str = M.DEFAULT_NAMESPACE) -> Version:
        """Drop one namespace; without a name, the default one."""
        token = M.DEFAULT_TOKEN if namespace == M.DEFAULT_NAMESPACE else namespace
        base = self.version()
        if token not in base.tokens():
            return base
        return self.commit(base, {s: [t for t in tokens if t != token] for s, tokens in base.live.items()})

    def delete_all(self) -> Version:
        base = self.version()
        return self.commit(base, {}) if base.live else base

    def delete_default_counted(self) -> tuple[int, int]:
        """Drop the default namespace and count the records of the collection before and after."""
        before = self.read().count()
        if before == 0:
            return 0, 0
        self.delete_namespace()
        return before, self.read().count()


def _complete(changes: DataFrame, dimension: int | None) -> DataFrame:
    """Changes with all record columns; a record that cannot be stored fails the job that reads it."""
    for f in M.RECORD_FIELDS:
        if f.name not in changes.columns:
            changes = changes.withColumn(f.name, F.lit(None).cast(f.dataType))

    def required(name: str, kind: str, rule: str, text: str) -> Column:
        return F.expr(f"CASE WHEN {rule} THEN {name} ELSE CAST(raise_error('{text}') AS {kind}) END")

    sized_right = "values IS NOT NULL" if dimension is None else f"coalesce(size(values) = {dimension}, false)"
    return changes.withColumns({
        "namespace": required("namespace", "string", "namespace IS NOT NULL", "namespace must not be NULL"),
        "id": required("id", "string", "id IS NOT NULL", "id must not be NULL"),
        "values": required("CAST(values AS array<double>)", "array<double>", sized_right,
                           f"values must have {dimension or 'some'} elements"),
    })


def _older() -> Column:
    """Whether a change is older than the record it meets. Without a number on either side it isn't."""
    return F.coalesce(F.col("seq") > F.col("new_seq"), F.lit(False))


def newest(changes: DataFrame, seq: str = "seq", keep: bool = False) -> DataFrame:
    """One record per namespace and id. The rank filter limits groups before the shuffle, so many changes to
    one id do not meet in one task. Equal ``seq`` values are settled by content, the same way in every run."""
    content = [c for c in ("values", "metadata", "sparse_values") if c in changes.columns]
    w = Window.partitionBy("namespace", "id").orderBy(F.desc(seq), F.xxhash64(*content))
    return changes.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == 1) \
        .drop("rank", *([] if keep else [seq]))


def upserted(base: DataFrame, changes: DataFrame, seq: str = "seq") -> DataFrame:
    """The table an upsert leads to, without writing it."""
    new = newest(changes, seq).select(*base.columns)
    keys = new.select("namespace", "id")
    return base.join(keys, ["namespace", "id"], "left_anti").select(*base.columns).unionByName(new)


def collection_stats(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """Vectors per namespace and in total, sorted by name with the total last.

    Without a known dimension the longest vector gives it, which reads the vectors; with it only the namespace
    is read, and the counts come from file footers.
    """
    size = F.max(F.size("values")) if dimension is None else F.lit(dimension)
    counts = vectors.groupBy("namespace").agg(F.count("*").alias("vectors"), size.alias("dimension"))
    return counts.rollup("namespace").agg(
        (F.grouping("namespace") == 1).alias("is_total"), F.sum("vectors").alias("vector_count"),
        F.max("dimension").cast("long").alias("dimension")).orderBy("is_total", "namespace")
