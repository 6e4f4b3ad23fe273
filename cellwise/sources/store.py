"""A versioned cell table on plain Parquet, with an atomic publish step.

Layout under ``path``::

    data/v=<version>/family=<family>/region=<region>/part-*.parquet
    _manifest/                 Spark-written JSON rows, appended, never edited

A write stages a new version directory (sorted, one key range per region);
``publish`` appends one manifest row, and only then do readers see it.  A
failed or unpublished stage is never read and never deleted.  Reads merge all
published versions newest-cell-wins, so a write is an upsert.  A snapshot is a
named, frozen list of versions: later writes do not change what it reads.

Single writer per table (batch, day or hour cadence); concurrent writers are
out of scope.
"""
from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate
from operator import or_
from typing import Mapping as TMapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..mapping import Mapping
from ..operators.encode import encode_key, table_to_cells
from ..operators.encode import key_type as mapping_key_type
from ..operators.joins import estimated_bytes
from ..operators.regions import (_plain, region_bounds, region_expr, region_of, region_weights, split_points,
                                 task_shares)
from ..session import list_file_sizes, path_exists

# ``points`` are the split points of that version's regions: text, or hex where
# the key type is binary.  A snapshot freezes the versions live at its own id.
MANIFEST_DDL = ("id long, kind string, name string, version int, versions array<int>, "
                "points array<string>, key_type string, created_ms long, buckets int, "
                "bucket_skew double")

# Internal columns of rows on their way to the write tasks.
_KEY, _REGION = "_cw_key", "_cw_region"

# Default size of what one write task sorts.
WRITE_TASK_BYTES = 512 << 20

# Cells that one write task sorts, and one bucket holds, by default: files of cells pack
# well, so that their bytes say little about the memory of a sort.
TASK_CELLS = 4_000_000

# Parquet writer options a family layout may set.
LAYOUT_OPTIONS = ("compression", "parquet.block.size", "parquet.page.size",
                  "parquet.enable.dictionary", "parquet.bloom.filter.enabled#row_key",
                  "parquet.bloom.filter.expected.ndv#row_key")


class StoreError(RuntimeError):
    pass


@dataclass
class WriteResult:
    version: int
    stage: str
    points: list
    key_type: str = "string"
    families: list = field(default_factory=list)


class CellStore:
    """``buckets=n`` selects the bucketed layout: each version is written
    ``bucketBy(n, row_key)`` (sorted within files) instead of by region.  Read
    with ``bucketed=True``, a full pivot needs no shuffle: each task reads all
    files of one bucket, which suits keys of which none dominates
    (:meth:`bucket_skew` tells).  The default read is the plain one, in which a
    dominant key is folded by partial aggregation before the shuffle.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        if not path:
            raise StoreError("a table path is required")
        self.spark = spark
        self.path = path.rstrip("/")
        self.data = f"{self.path}/data"
        self.manifest_path = f"{self.path}/_manifest"
        recorded = self._recorded_buckets()
        if buckets and recorded and buckets != recorded:
            raise StoreError(f"table is bucketed into {recorded}, not {buckets}")
        self.buckets = recorded or buckets

    # ------------------------------------------------------------ manifest
    def _manifest(self) -> list:
        """Manifest rows in commit order (one small read, kept until this
        object appends; another writer's commits show up on a new object)."""
        cached = getattr(self, "_manifest_rows", None)
        if cached is not None:
            return cached
        if not path_exists(self.spark, self.manifest_path):
            return []
        rows = self.spark.read.schema(MANIFEST_DDL).json(self.manifest_path).collect()
        self._manifest_rows = sorted(rows, key=lambda r: r["id"])
        return self._manifest_rows

    def _append(self, kind: str, **kw) -> None:
        rows = self._manifest()
        nid = (rows[-1]["id"] + 1) if rows else 1
        rec = {"id": nid, "kind": kind, "name": kw.get("name"), "version": kw.get("version"),
               "versions": kw.get("versions"), "points": kw.get("points"),
               "key_type": kw.get("key_type"), "created_ms": int(time.time() * 1000),
               "buckets": kw.get("buckets"), "bucket_skew": kw.get("bucket_skew")}
        (self.spark.createDataFrame([rec], MANIFEST_DDL).coalesce(1)
         .write.mode("append").json(self.manifest_path))
        self._manifest_rows = None

    def _recorded_buckets(self) -> int | None:
        for r in self._manifest():
            if r["kind"] == "commit" and r["buckets"]:
                return int(r["buckets"])
        return None

    def _table(self, key_type: str) -> str:
        """Register the bucketed layout as a catalog table over ``data`` (once
        per session) and pick up partitions written since."""
        import hashlib
        name = "cellwise_" + hashlib.md5(self.data.encode()).hexdigest()[:16]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (row_key {key_type}, qualifier string, ts bigint, "
            f"seq bigint, value binary, v int, family string) USING parquet "
            f"PARTITIONED BY (v, family) CLUSTERED BY (row_key) "
            f"SORTED BY (row_key, qualifier, ts) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.data}'")
        return name

    def committed(self, upto: int | None = None) -> list[int]:
        """Live versions: commits in order, up to manifest row ``upto``; a commit
        that lists ``versions`` (a compaction) replaces those it was made of."""
        live: list[int] = []
        for r in self._manifest():
            if r["kind"] == "commit" and (upto is None or r["id"] <= upto):
                gone = set(r["versions"] or ())
                live = [v for v in live if v not in gone] + [r["version"]]
        return live

    def _commits(self) -> list:
        return [r for r in self._manifest() if r["kind"] == "commit"]

    def points(self) -> list:
        """Split points of the last commit."""
        commits = self._commits()
        return _typed_points(commits[-1]) if commits else []

    def key_type(self) -> str | None:
        """Type of the row key: that of the first commit, kept by all others."""
        commits = self._commits()
        return commits[0]["key_type"] if commits else None

    def _checked_key_type(self, df: DataFrame) -> str:
        kt = dict(df.dtypes)["row_key"]
        if kt not in ("string", "binary"):
            raise StoreError(f"row keys are string or binary, not {kt}")
        if self.key_type() not in (None, kt):
            raise StoreError(f"the table's row keys are {self.key_type()}, not {kt}")
        return kt

    def _next_version(self) -> int:
        rows = self._manifest()
        seen = [r["version"] for r in rows if r["version"] is not None]
        v = max(seen) + 1 if seen else 1
        while path_exists(self.spark, f"{self.data}/v={v}"):
            v += 1          # an unpublished stage keeps its number
        return v

    # --------------------------------------------------------------- write
    def stage(
        self,
        cells: DataFrame,
        *,
        points: Sequence | None = None,
        regions: int | None = None,
        mode: str = "split",
        tasks: int | None = None,
        layout: TMapping[str, dict] | dict | None = None,
    ) -> WriteResult:
        """Write ``cells`` as a new, unpublished version (B8 + B10).

        Split points come from ``points``, else from the data (``regions``
        pieces), else from the last commit.  ``tasks`` defaults to the largest
        of the session's cores, the input's estimated size over 512 MB and its
        cells over ``TASK_CELLS`` (counted; ``"range"`` and ``"hash"`` read the
        input once more for that).
        ``mode``:

        * ``"split"`` – every region is written by its share of the tasks, by
          its number of cells (``repartitionById`` on the region's first task +
          ``hash(cell) % its tasks``): files are sorted and never cross a
          region, and a hot region, row or cell is spread over as many tasks as
          its size asks for.  One count by region goes before, over the key
          column only; files of one region overlap in key range (reads merge
          them anyway).
        * ``"range"`` – range-partition on (region, row_key, family, qualifier,
          ts desc) over ``tasks`` tasks: files of a region also hold
          consecutive key ranges (a total order across files), at the price of
          Spark's sampling job, which reads the input once more.
        * ``"rebalance"`` – by region, split and coalesced by AQE.
        * ``"exact"`` – one task per region (``repartitionById``); the largest
          region sets the time.
        * ``"hash"`` – hash layout by row key, sorted within files only
          (regions' files overlap; kept for comparison).

        ``layout`` holds Parquet options, for all families or per family ("*":
        the families not named).  A bucketed table takes none of ``points``,
        ``regions``, ``mode`` and ``layout``.
        """
        for c in ("row_key", "family", "qualifier", "ts", "seq", "value"):
            if c not in cells.columns:
                raise StoreError(f"cells need column {c!r}")
        kt = self._checked_key_type(cells)
        if self.buckets:
            self._no_layout(points, regions, mode, layout)
            return self._stage_bucketed(cells, tasks)
        if points is None:
            points = split_points(cells, "row_key", regions) if regions else self.points()
        df = cells.select("row_key", "family", "qualifier", "ts", "seq", "value") \
            .withColumn("region", region_expr(F.col("row_key"), points))

        def deal(families) -> DataFrame:
            part = df if families is None else df.where(families(F.col("family")))
            return self._dealt(part, len(points) + 1, mode, tasks,
                               ("row_key", "family", "qualifier", "ts"))
        return self._stage(deal, list(points), kt, layout)

    def _dealt(self, df: DataFrame, n: int, mode: str, tasks: int | None, spread: Sequence[str],
               key: str = "row_key", region: str = "region", fan: int = 1) -> DataFrame:
        """``df`` dealt to the write tasks by its region column; ``spread`` are the
        columns whose hash spreads a region over its tasks, ``fan`` the cells that
        each row becomes."""
        if mode == "rebalance":
            return df.hint("rebalance", region)
        weights = region_weights(df, region) if mode == "split" else None
        ntasks = tasks
        if not tasks and mode in ("split", "range", "hash"):
            rows = sum(weights.values()) if weights is not None else df.count()
            ntasks = max(n, self._cores(), -(-_estimated_bytes(df) // WRITE_TASK_BYTES), -(-rows * fan // TASK_CELLS))
        if mode == "split":
            shares = task_shares(weights, n, ntasks)
            first = [0, *accumulate(shares)]
            place = F.coalesce(F.col(region), F.lit(0)) + 1
            sub = F.pmod(F.xxhash64(*spread), F.element_at(F.expr(f"array({','.join(map(str, shares))})"), place))
            start = F.element_at(F.expr(f"array({','.join(map(str, first[:-1]))})"), place)
            return df.repartitionById(first[-1], (start + sub).cast("int"))
        if mode == "range":
            cells = {"family", "qualifier", "ts"} <= set(df.columns) and key == "row_key"
            return df.repartitionByRange(ntasks, F.col(region), F.col(key), *(
                ["family", "qualifier", F.col("ts").desc()] if cells else []))
        if mode == "exact":
            return df.repartitionById(n, F.coalesce(F.col(region), F.lit(0)))
        if mode == "hash":
            return df.repartition(ntasks, key)
        raise StoreError(f"unknown mode {mode!r}")

    def _stage(self, deal, points: list, kt: str, layout) -> WriteResult:
        """Write the next version.  ``deal(families)`` gives the dealt cells of
        the families for which the condition holds (None: of all).  Each family
        with a layout of its own is dealt and written alone: only its own cells,
        or its own columns of the rows, go through the shuffle."""
        version = self._next_version()
        stage = f"{self.data}/v={version}"

        def put(part: DataFrame, path: str, parts: list, opts: dict) -> None:
            # the sort starts with the writer's partition columns, so the file
            # writer keeps this order instead of re-sorting
            order = [*parts, "row_key", "qualifier", F.col("ts").desc(), F.col("seq").desc()]
            if "family" not in parts:
                part = part.drop("family")
            self._write(part.sortWithinPartitions(*order), path, parts, opts)

        per_family = isinstance(layout, dict) and layout and all(
            isinstance(v, dict) for v in layout.values())
        if not per_family:
            put(deal(None), stage, ["family", "region"], dict(layout or {}))
            return WriteResult(version, stage, points, kt)
        named = [f for f in layout if f != "*"]
        rest = deal(lambda fam: ~fam.isin(named) if isinstance(fam, Column) else fam not in named)
        if rest is not None:
            put(rest, stage, ["family", "region"], dict(layout.get("*", {})))
        for f in named:
            part = deal(lambda fam, f=f: fam == f)
            if part is not None:
                put(part, f"{stage}/family={f}", ["region"], dict(layout[f]))
        return WriteResult(version, stage, points, kt, named)

    def _no_layout(self, points, regions, mode, layout) -> None:
        if points or regions or layout or mode != "split":
            raise StoreError("a bucketed table takes no points, regions, mode or layout")

    def _cores(self) -> int:
        return max(1, self.spark.sparkContext.defaultParallelism)

    def _stage_bucketed(self, cells: DataFrame, tasks: int | None) -> WriteResult:
        """Each bucket is written by k tasks (hash of the cell within the
        bucket), so a hot key's bucket is still spread over k writers."""
        version = self._next_version()
        kt = dict(cells.dtypes)["row_key"]
        name = self._table(kt)
        n = self.buckets
        ntasks = tasks or max(n, self._cores(), -(-_estimated_bytes(cells) // WRITE_TASK_BYTES))
        k = max(2, -(-ntasks // n))
        bucket = F.pmod(F.hash("row_key"), F.lit(n))       # Spark's own bucket id
        sub = F.pmod(F.xxhash64("row_key", "family", "qualifier", "ts"), F.lit(k))
        df = (cells.withColumn("v", F.lit(version))
              .select("row_key", "qualifier", "ts", "seq", "value", "v", "family")
              .repartitionById(n * k, (bucket * k + sub).cast("int")))
        df.write.insertInto(name)
        return WriteResult(version, f"{self.data}/v={version}", [], kt)

    def _bucket_skew(self, stage: str) -> float:
        import re
        sizes: dict[int, int] = {}
        for f, b in list_file_sizes(self.spark, stage):
            m = re.search(r"_(\d{5})\.", f.rsplit("/", 1)[-1])
            if m:
                sizes[int(m.group(1))] = sizes.get(int(m.group(1)), 0) + b
        if not sizes:
            return 0.0
        mean = sum(sizes.values()) / self.buckets
        return max(sizes.values()) / mean if mean else 0.0

    def _write(self, df: DataFrame, path: str, parts: list, opts: dict) -> None:
        for k in opts:
            if k not in LAYOUT_OPTIONS:
                raise StoreError(f"unknown layout option {k!r}")
        w = df.write.mode("errorifexists").partitionBy(*parts)
        for k, v in opts.items():
            w = w.option(k, str(v))
        w.parquet(path)

    def publish(self, result: WriteResult) -> int:
        """Make a staged version visible: one manifest row, written last."""
        return self._commit(result)

    def _commit(self, result: WriteResult, replaces: Sequence[int] | None = None) -> int:
        if not path_exists(self.spark, result.stage):
            raise StoreError(f"stage {result.stage} does not exist")
        if result.version in self.committed():
            raise StoreError(f"version {result.version} already published")
        if self.key_type() not in (None, result.key_type):
            raise StoreError(f"the table's row keys are {self.key_type()}, not {result.key_type}")
        skew = self._bucket_skew(result.stage) if self.buckets else None
        points = [bytes(p).hex() if result.key_type == "binary" else str(p) for p in result.points]
        self._append("commit", version=result.version, versions=list(replaces) if replaces else None,
                     points=points, key_type=result.key_type, buckets=self.buckets, bucket_skew=skew)
        return result.version

    def write(self, cells: DataFrame, **kw) -> int:
        """Stage and publish (``bulk_write``)."""
        return self.publish(self.stage(cells, **kw))

    def stage_rows(self, df: DataFrame, m: Mapping, ts=None, seq=0, *, points: Sequence | None = None,
                   regions: int | None = None, mode: str = "split", tasks: int | None = None,
                   layout: TMapping[str, dict] | dict | None = None) -> WriteResult:
        """Typed rows as a new, unpublished version: rows are dealt to the write
        tasks, and only there do they fan out to cells, so that a row crosses
        the network once whatever its columns."""
        if self.buckets:
            self._no_layout(points, regions, mode, layout)
            return self.stage(table_to_cells(df, m, ts=ts, seq=seq), tasks=tasks)
        key = encode_key(F.col(m.key.name), m)
        kt = mapping_key_type(m)
        if self.key_type() not in (None, kt):
            raise StoreError(f"the table's row keys are {self.key_type()}, not {kt}")
        if points is None:
            points = split_points(df, key, regions) if regions else self.points()
        # write times and sequence numbers are set before rows are dealt; the key is a
        # column before its region is searched
        own = {n: c for n, c in (("_cw_ts", ts), ("_cw_seq", seq)) if isinstance(c, Column)}
        df = df.withColumns({**own, _KEY: key}).withColumn(_REGION, region_expr(F.col(_KEY), points))
        ts, seq = (F.col(n) if n in own else c for n, c in (("_cw_ts", ts), ("_cw_seq", seq)))

        def deal(families) -> DataFrame | None:
            part, mm = df, m
            if families is not None:
                fields = [f for f in m.fields if f.family is not None and families(f.family)]
                if not fields:
                    return None
                gone = {f.name for f in m.fields if f.family is not None} - {f.name for f in fields}
                part, mm = df.drop(*gone), m.select([f.name for f in m.fields if f.name not in gone])
            plain = [f.name for f in part.schema.fields
                     if "map<" not in f.dataType.simpleString() and f.name != _REGION]
            fan = max(1, len([f for f in mm.fields if f.family is not None]))
            dealt = self._dealt(part, len(points) + 1, mode, tasks, plain, _KEY, _REGION, fan)
            return table_to_cells(dealt, mm, ts=ts, seq=seq, carry=[_REGION]).withColumnRenamed(_REGION, "region")
        return self._stage(deal, list(points), kt, layout)

    def write_table(self, df: DataFrame, m: Mapping, ts=None, seq=0, **kw) -> int:
        """Typed rows → cells → new version (B5): an upsert, never a truncate."""
        return self.publish(self.stage_rows(df, m, ts=ts, seq=seq, **kw))

    def layout_facts(self, version: int) -> DataFrame:
        """What the Parquet footers of a version say, one row per file: ``family,
        file, codec, row_groups, rows, key_bloom_filter, dictionary`` (of any of
        its column chunks).  A diagnostic: footers only, read by the driver."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        rows = []
        for name, _ in list_file_sizes(self.spark, f"{self.data}/v={version}"):
            if not name.endswith(".parquet"):
                continue
            source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
            try:
                blocks = list(reader.getFooter().getBlocks())
                chunks = [c for b in blocks for c in b.getColumns()]
                keys = [c for c in chunks if c.getPath().toDotString() == "row_key"]
                rows.append((name.partition("/family=")[2].partition("/")[0], name.rsplit("/", 1)[-1],
                             ",".join(sorted({c.getCodec().toString().lower() for c in chunks})), len(blocks),
                             sum(b.getRowCount() for b in blocks), bool(keys) and all(c.getBloomFilterOffset() > 0 for c in keys),
                             any(c.hasDictionaryPage() for c in chunks)))
            finally:
                reader.close()
        return self.spark.createDataFrame(rows, "family string, file string, codec string, row_groups int, rows bigint, "
                                                "key_bloom_filter boolean, dictionary boolean")

    # ---------------------------------------------------------------- read
    def read(self, *, snapshot: str | None = None, versions: Sequence[int] | None = None,
             key_lo=None, key_hi=None, keys: Sequence | None = None, families: Sequence[str] | None = None,
             bucketed: bool = False) -> DataFrame:
        """All cells of the published versions (or of a snapshot), with
        ``region`` and ``v`` columns.  Key bounds (inclusive) and ``keys`` (a
        point lookup; for many, see :meth:`lookup`) add region pruning on top of
        the row-key filter: each version by its own split points, down to the
        regions that can hold one of the keys.  The keys reach the scan, where
        row-group statistics, page indexes and bloom filters skip the rest.
        Families prune directories.  ``bucketed`` reads a bucketed table bucket
        by bucket (see the class).
        """
        if snapshot is not None:
            snaps = self._snapshots()
            if snapshot not in snaps:
                raise StoreError(f"no snapshot {snapshot!r}")
            versions = snaps[snapshot]
        elif versions is None:
            versions = self.committed()
        versions = list(versions)
        kt = self.key_type() or "string"
        schema = (f"row_key {kt}, qualifier string, ts bigint, seq bigint, value binary, "
                  f"v int, family string, region int")
        if not versions:
            return self.spark.createDataFrame([], schema).select(*_CELL_READ)
        if self.buckets:
            df = self._read_bucketed(versions, kt, bucketed)
        else:
            df = (self.spark.read.schema(schema).option("basePath", self.data)
                  .parquet(*[f"{self.data}/v={v}" for v in versions]))
        if families:
            df = df.where(F.col("family").isin(list(families)))
        if key_lo is not None or key_hi is not None:
            if not self.buckets:
                df = df.where(self._regions_of(versions, key_lo, key_hi))
            if key_lo is not None:
                df = df.where(F.col("row_key") >= F.lit(key_lo))
            if key_hi is not None:
                df = df.where(F.col("row_key") <= F.lit(key_hi))
        if keys is not None:
            keys = sorted({_plain(k) for k in keys})
            if not self.buckets:
                df = df.where(self._regions_with(versions, keys))
            df = df.where(F.col("row_key").isin(keys) if keys else F.lit(False))
        return df.select(*_CELL_READ)

    def lookup(self, keys: DataFrame, key: str = "row_key", **read) -> DataFrame:
        """The cells whose row key is in column ``key`` of ``keys``, of any
        number of rows: a semi-join, for which Spark pushes a runtime filter
        (bloom filter or key set) into the scan where that pays."""
        wanted = keys.select(F.col(key).alias("_cw_key")).distinct()
        cells = self.read(**read)
        return cells.join(wanted, cells["row_key"] == wanted["_cw_key"], "left_semi")

    def _regions_with(self, versions: list, keys: list) -> Column:
        """The (version, region) directories that can hold one of ``keys``."""
        points = {r["version"]: _typed_points(r) for r in self._commits()}
        terms: dict[tuple, list] = {}
        for v in versions:
            terms.setdefault(tuple(sorted({region_of(points[v], k) for k in keys})), []).append(v)
        return reduce(or_, [F.col("v").isin(vs) & F.col("region").isin(list(regions))
                            for regions, vs in sorted(terms.items())])

    def _regions_of(self, versions: list, key_lo, key_hi) -> Column:
        """The (version, region) directories a key range can touch; versions
        with the same bounds share one term."""
        points = {r["version"]: _typed_points(r) for r in self._commits()}
        terms: dict[tuple, list] = {}
        for v in versions:
            terms.setdefault(region_bounds(points[v], key_lo, key_hi), []).append(v)
        conds = [F.col("v").isin(vs) & F.col("region").between(lo, hi)
                 for (lo, hi), vs in sorted(terms.items())]
        return reduce(or_, conds)

    def _read_bucketed(self, versions: list, kt: str, bucketed: bool) -> DataFrame:
        if bucketed:
            name = self._table(kt)
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            df = self.spark.table(name).where(F.col("v").isin(versions))
        else:
            schema = (f"row_key {kt}, qualifier string, ts bigint, seq bigint, value binary, "
                      f"v int, family string")
            df = (self.spark.read.schema(schema).option("basePath", self.data)
                  .parquet(*[f"{self.data}/v={v}" for v in versions]))
        return df.withColumn("region", F.lit(None).cast("int"))

    def bucket_skew(self) -> dict[int, float]:
        """Largest bucket over the mean bucket, per published version."""
        return {r["version"]: r["bucket_skew"] for r in self._manifest()
                if r["kind"] == "commit" and r["buckets"]}

    # ----------------------------------------------------------- snapshots
    def _snapshots(self) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for r in self._manifest():
            if r["kind"] == "snapshot":
                out[r["name"]] = self.committed(upto=r["id"])
            elif r["kind"] == "drop":
                out.pop(r["name"], None)
        return out

    def snapshot_create(self, name: str) -> list[int]:
        """Freeze the published versions under ``name`` (replaces a snapshot of
        the same name)."""
        if not name:
            raise StoreError("a snapshot needs a name")
        vs = self.committed()
        self._append("snapshot", name=name)
        return vs

    def snapshot_drop(self, name: str) -> None:
        if name not in self._snapshots():
            raise StoreError(f"no snapshot {name!r}")
        self._append("drop", name=name)

    def snapshot_list(self) -> DataFrame:
        rows = [(k, v) for k, v in sorted(self._snapshots().items())]
        return self.spark.createDataFrame(rows, "name string, versions array<int>")

    # ------------------------------------------------------------- upkeep
    def compact(self, versions: Sequence[int] | None = None, keep: str = "all", **kw) -> int:
        """Rewrite ``versions`` (default: all live ones) as one and publish it in
        their place; the old files stay for existing snapshots.  ``keep="all"``
        keeps every version of every cell, so reads as of a time, in a time
        range or of several versions are unchanged; ``keep="latest"`` keeps the
        newest cell only."""
        from ..operators.scan import latest
        if keep not in ("all", "latest"):
            raise StoreError("keep is 'all' or 'latest'")
        live = self.committed()
        versions = live if versions is None else list(versions)
        if not versions or set(versions) - set(live):
            raise StoreError("only live versions can be compacted")
        cells = self.read(versions=versions).drop("region", "v")
        if keep == "latest":
            cells = latest(cells)
        if not self.buckets:
            kw.setdefault("points", self.points())
        return self._commit(self.stage(cells, **kw), replaces=versions)


def buckets_for(cells: int, least: int = 8) -> int:
    """Buckets of a table that is to hold so many cells: a bucket is read by one task."""
    return max(least, -(-cells // TASK_CELLS))


def _typed_points(commit) -> list:
    pts = commit["points"] or []
    return [bytes.fromhex(p) if commit["key_type"] == "binary" else p for p in pts]


def _estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the plan; 0 where it has none (it then says
    exabytes, as for rows that come from Python)."""
    size = estimated_bytes(df)
    return size if size < 1 << 53 else 0


_CELL_READ = ("row_key", "family", "qualifier", "ts", "seq", "value", "region", "v")


def multi_insert(df: DataFrame, sinks: Sequence[tuple], materialize: str = "none") -> list:
    """One source, several sinks (B11): ``sinks`` is ``[(condition, fn)]``;
    each ``fn`` receives ``df.where(condition)``.

    * ``"none"`` – each sink reads the source with its own condition, which
      reaches the scan.
    * ``"checkpoint"`` – the source is computed and written once to the
      session's ``spark.checkpoint.dir`` (a shared folder on a cluster): for
      sources that cost more to compute than to read.  A lost executor costs a
      re-read of the checkpoint, never a recompute of the source.
    """
    if materialize == "checkpoint":
        from ..session import checkpoint_root
        checkpoint_root(df.sparkSession)          # set only where unset (tests)
        src = df.checkpoint(eager=True)
    elif materialize == "none":
        src = df
    else:
        raise StoreError(f"unknown materialize {materialize!r}")
    return [fn(src.where(cond)) for cond, fn in sinks]


def export_table(cells: DataFrame, m: Mapping, path: str, *, columns=None, key_lo=None,
                 key_hi=None, fmt: str = "parquet", mode: str = "errorifexists",
                 options: dict | None = None) -> DataFrame:
    """Read all or some columns, all or a key range, into a plain table
    (B14); returns the written table read back lazily."""
    from ..operators.predicates import key_range
    from ..operators.scan import scan_table
    src = key_range(cells, key_lo, key_hi, True, True)
    t = scan_table(src, m, columns)
    w = t.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    r = cells.sparkSession.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true").schema(t.schema)
    return r.load(path)



