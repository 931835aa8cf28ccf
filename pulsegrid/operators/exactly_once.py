"""Messages delivered more than once: exactly one copy of each stays.

Method: an index of all identifiers seen, kept as immutable runs in a table that is bucketed by hash prefix. A run holds
one row per prefix with the sorted identifiers of that prefix and, beside each, the copy that stays. A batch is
deduplicated locally while it is read and shuffled by prefix; the runs stay where they are, and each novel identifier is
looked up in their sorted arrays by binary search. The identifiers that are new, or now have a better copy, become the
next run; runs are merged now and then.

An identifier is (source hash, millisecond): exact in time, hashed only over sources, of which there are few. Arrays are
sorted by a hash of it; where two identifiers share that hash, both are compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import key_hash
from ..session import drop_path, path_exists

LATE = np.iinfo(np.int64).max  # stands for a missing fetch time: such a copy comes last
BUFFER = 131_072  # rows that a task deduplicates at once before it shuffles
PREFIX_ROWS = 200_000  # identifiers of the first batch that share a prefix, about
_LONGS = ("id", "src", "ms", "fetched", "row_id")
CELL = pa.schema([("run", pa.int64()), ("prefix", pa.int32())] + [(c, pa.list_(pa.int64())) for c in _LONGS] + [("chunk", pa.list_(pa.int32())), ("chunks", pa.list_(pa.string())), ("dropped", pa.list_(pa.int64()))])
DDL = "run long, prefix int, " + ", ".join(f"{c} array<bigint>" for c in _LONGS) + ", chunk array<int>, chunks array<string>, dropped array<bigint>"


class _Ids:
    """Identifiers with their copies, as parallel arrays; ``chunk`` indexes the sorted ``chunks`` (null last)."""

    def __init__(self, ids, src, ms, fetched, chunk, row_id, chunks):
        self.ids, self.src, self.ms, self.fetched, self.chunk, self.row_id = (np.asarray(x, np.int64) for x in (ids, src, ms, fetched, chunk, row_id))
        self.chunks = chunks

    def take(self, at) -> _Ids:
        return _Ids(self.ids[at], self.src[at], self.ms[at], self.fetched[at], self.chunk[at], self.row_id[at], self.chunks)

    def rank(self) -> list[np.ndarray]:
        return [self.fetched, self.chunk, self.row_id]

    def first_copies(self) -> tuple[_Ids, np.ndarray]:
        """Sorted by identifier with the best copy of each, and the row ids of the others."""
        order = np.lexsort((self.row_id, self.chunk, self.fetched, self.ms, self.src, self.ids))
        i, s, m = self.ids[order], self.src[order], self.ms[order]
        best = np.r_[True, (i[1:] != i[:-1]) | (s[1:] != s[:-1]) | (m[1:] != m[:-1])] if len(i) else np.zeros(0, bool)
        return self.take(order[best]), self.row_id[order[~best]]

    def find(self, wanted: _Ids) -> np.ndarray:
        """Where each wanted identifier is in these sorted ones, -1 if nowhere: binary search, then on past equal hashes."""
        at = np.searchsorted(self.ids, wanted.ids)
        found = np.full(len(at), -1)
        open_ = np.arange(len(at))
        while len(open_):
            open_ = open_[at[open_] < len(self.ids)]
            open_ = open_[self.ids[at[open_]] == wanted.ids[open_]]
            here = at[open_]
            hit = (self.src[here] == wanted.src[open_]) & (self.ms[here] == wanted.ms[open_])
            found[open_[hit]] = here[hit]
            open_ = open_[~hit]
            at[open_] += 1
        return found

    def cell(self, prefix: int, dropped: np.ndarray, run: int = 0) -> dict:
        used, codes = np.unique(self.chunk, return_inverse=True)
        names = [self.chunks[i] for i in used]
        return {"run": run, "prefix": prefix, "id": self.ids, "src": self.src, "ms": self.ms, "fetched": self.fetched, "row_id": self.row_id, "chunk": codes.astype(np.int32), "chunks": names, "dropped": dropped}


def _read(table: pa.Table, names: list[str | None]) -> list[_Ids]:
    """The rows of ``table`` as identifiers whose chunk codes refer to ``names``."""
    rank = {c: i for i, c in enumerate(names)}
    out = []
    for row in range(table.num_rows):
        get = lambda c, row=row: table.column(c)[row].values.to_numpy(zero_copy_only=False)
        if len(get("id")):
            recode = np.array([rank[c] for c in table.column("chunks")[row].as_py()], np.int64)
            out.append(_Ids(get("id"), get("src"), get("ms"), get("fetched"), recode[get("chunk")], get("row_id"), names))
    return out


def _names(*tables: pa.Table) -> list[str | None]:
    found = {c for t in tables for row in t.column("chunks").to_pylist() for c in row}
    return sorted(c for c in found if c is not None) + ([None] if None in found else [])


def _concat(parts: list[_Ids], names: list[str | None]) -> _Ids:
    if not parts:
        return _Ids([], [], [], [], [], [], names)
    return _Ids(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("ids", "src", "ms", "fetched", "chunk", "row_id")), names)


def _table(cells: list[dict]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([c[f.name] for c in cells], f.type) for f in CELL], schema=CELL)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (prefix, id, src, ms, fetched, chunk, row_id) to cells, one per prefix and buffer, without local copies."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        codes = t.column("chunk").combine_chunks().dictionary_encode()
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        words = codes.dictionary.to_pylist()
        names: list[str | None] = [*sorted(words), None]
        rank = np.array([*(names.index(w) for w in words), len(words)], np.int64) if len(words) < 64 else np.array([*np.argsort(np.argsort(np.array(words, object))), len(words)], np.int64)
        chunk = rank[np.nan_to_num(codes.indices.to_numpy(zero_copy_only=False), nan=len(words)).astype(np.int64)]
        prefix, ids, src, ms, fetched, row_id = (t.column(c).to_numpy() for c in ("prefix", *_LONGS))
        by = np.argsort(prefix, kind="stable")
        cuts = np.r_[0, np.flatnonzero(np.diff(prefix[by])) + 1, len(by)]
        cells = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                at = by[a:b]
                kept, lost = _Ids(ids[at], src[at], ms[at], fetched[at], chunk[at], row_id[at], names).first_copies()
                cells.append(kept.cell(int(prefix[at[0]]), lost))
        yield from _table(cells).to_batches()

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BUFFER:
            yield from flush(held)
            held, n = [], 0
    if n:
        yield from flush(held)


def _less(a, b) -> np.ndarray:
    return (a[0] < b[0]) | ((a[0] == b[0]) & ((a[1] < b[1]) | ((a[1] == b[1]) & (a[2] < b[2]))))


def _admit(run: int):
    def admit(new: pa.Table, runs: pa.Table) -> pa.Table:
        """The next run's row for one prefix: what is novel or better than the index has, and the row ids that lose."""
        if not new.num_rows:
            return CELL.empty_table()
        names = _names(new, runs)
        fresh, lost = _concat(_read(new, names), names).first_copies()
        dropped = [lost, *(x.values.to_numpy(zero_copy_only=False) for x in new.column("dropped"))]
        n = len(fresh.ids)
        best = [np.full(n, LATE) for _ in range(3)]  # fetched, chunk, row id of the copy that the index keeps
        known = np.zeros(n, bool)
        for old in _read(runs, names):
            at = old.find(fresh)
            hit = np.flatnonzero(at >= 0)
            theirs = [c[at[hit]] for c in old.rank()]
            better = ~known[hit] | _less(theirs, [b[hit] for b in best])
            for b, t in zip(best, theirs, strict=True):
                b[hit[better]] = t[better]
            known[hit] = True
        wins = ~known | _less(fresh.rank(), best)
        dropped += [best[2][known & wins], fresh.row_id[~wins & (fresh.row_id != best[2])]]
        return _table([fresh.take(wins).cell(new.column("prefix")[0].as_py(), np.concatenate(dropped), run)])

    return admit


def _merge(run: int):
    def merge(runs: pa.Table) -> pa.Table:
        names = _names(runs)
        merged, _ = _concat(_read(runs, names), names).first_copies()  # displaced copies were dropped when displaced
        return _table([merged.cell(runs.column("prefix")[0].as_py(), np.zeros(0, np.int64), run)])

    return merge


class DeliveryIndex:
    """The persistent index under ``path``: folders ``index-<n>`` (the last one counts) and ``dropped-<n>``.

    The number of prefixes follows from the first batch, unless ``prefix_bits`` gives it; a prefix is worked on in one
    task, at some 50 bytes per identifier, so it should allow for growth. Copies share ``source`` and the millisecond of
    ``instant``; by ``fetched``, ``chunk`` (nulls last) and ``row_id`` the first stays, also if it comes in a later batch.
    Rows without instant or row id have no identifier and are never dropped. A batch that was only partly written leaves
    no run, and can be admitted again; one that was admitted before finds itself: the same rows stay, those that don't
    are listed once more.
    """

    def __init__(self, spark: SparkSession, path: str, *, source: tuple[str, ...] = ("stream", "entity", "field"), instant: str = "timestamp_utc", fetched: str = "fetched_at_utc", chunk: str = "chunk", row_id: str = "row_id", prefix_bits: int | None = None, merge_every: int = 4):
        self.spark, self.path, self.bits, self.merge_every = spark, path.rstrip("/"), prefix_bits, merge_every
        self.source, self.instant, self.fetched, self.chunk, self.row_id = source, instant, fetched, chunk, row_id
        at = self._versions("index")
        if at:  # an index that is there knows its own number of prefixes
            self.bits = int(at[-1].rsplit("-", 1)[1])

    def _versions(self, what: str) -> list[str]:
        """Finished folders of a kind, the oldest first."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted((n for n in names if n.startswith(f"{what}-") and path_exists(self.spark, f"{self.path}/{n}/_SUCCESS")), key=lambda n: int(n.split("-")[1]))

    def _bucketed(self, folder: str) -> str:
        """The table over a folder; its buckets let a lookup read the runs without moving them."""
        name = "deliveries_" + hashlib.md5(f"{self.path}/{folder}".encode()).hexdigest()
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} ({DDL}) USING parquet OPTIONS (compression 'zstd') CLUSTERED BY (prefix) INTO {2**self.bits} BUCKETS LOCATION '{self.path}/{folder}'")
        return name

    def runs(self) -> list[int]:
        """The numbers of the live runs."""
        at = self._versions("index")
        return sorted(r.run for r in self.spark.table(self._bucketed(at[-1])).select("run").distinct().collect()) if at else []

    def admit(self, batch: DataFrame) -> None:
        """Look up a batch and add a run."""
        src, ms = key_hash(*self.source), F.unix_millis(self.instant)
        known = batch.filter(F.col(self.instant).isNotNull() & F.col(self.row_id).isNotNull())
        if self.bits is None:
            self.bits = max(3, math.ceil(math.log2(max(1, known.count() / PREFIX_ROWS))))
        ident = F.xxhash64(src, ms)
        rows = known.select(
            F.shiftrightunsigned(ident, 64 - self.bits).cast("int").alias("prefix"), ident.alias("id"), src.alias("src"), ms.alias("ms"), F.coalesce(F.unix_micros(self.fetched), F.lit(int(LATE))).alias("fetched"), F.col(self.chunk).cast("string").alias("chunk"), F.col(self.row_id).cast("long").alias("row_id")
        )
        at = self._versions("index")
        folder = at[-1] if at else f"index-0-{self.bits}"
        live = self.runs()
        run = live[-1] + 1 if live else 0
        table = self._bucketed(folder)
        index = self.spark.table(table).withColumn("dropped", F.array().cast("array<bigint>"))  # the lists of dropped ids aren't read again
        found = rows.mapInArrow(_pack, DDL).groupBy("prefix").cogroup(index.groupBy("prefix")).applyInArrow(_admit(run), DDL)
        found.write.mode("append").insertInto(table)
        if len(live) + 1 > self.merge_every:
            self.compact()

    def compact(self) -> None:
        """Merge all live runs into one; the old ones go only once it is there, and their dropped ids are set aside."""
        live, at = self.runs(), self._versions("index")
        if len(live) < 2:
            return
        n = int(at[-1].split("-")[1]) + 1
        old, folder = self._bucketed(at[-1]), f"index-{n}-{self.bits}"
        self.spark.table(old).select("dropped").filter("size(dropped) > 0").write.mode("overwrite").parquet(f"{self.path}/dropped-{n}")
        index = self.spark.table(old).withColumn("dropped", F.array().cast("array<bigint>"))
        index.groupBy("prefix").applyInArrow(_merge(live[-1]), DDL).write.mode("overwrite").insertInto(self._bucketed(folder))
        drop_path(self.spark, f"{self.path}/{at[-1]}")

    def dropped(self) -> DataFrame:
        """``row_id`` of every copy that doesn't stay, of all batches so far."""
        aside, at = self._versions("dropped"), self._versions("index")
        lists = self.spark.table(self._bucketed(at[-1])).select("dropped") if at else self.spark.createDataFrame([], "dropped array<bigint>")
        for folder in aside:
            lists = lists.unionByName(self.spark.read.parquet(f"{self.path}/{folder}"))
        return lists.select(F.explode("dropped").alias(self.row_id))


def arrival_batches(rows: DataFrame, n: int, row_id: str = "row_id") -> list[DataFrame]:
    """``rows`` cut into ``n`` batches of consecutive arrival numbers; the ranges are pushed into the scan."""
    lo, hi = rows.agg(F.min(row_id), F.max(row_id)).first()
    if lo is None:
        return []
    edges = [lo + (hi - lo + 1) * k // n for k in range(n + 1)]
    return [rows.filter((F.col(row_id) >= a) & (F.col(row_id) < b)) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]
