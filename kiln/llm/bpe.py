"""Operator 5: byte-level BPE encoding and decoding with DuckDB recursive queries per partition.

Each task keeps one in-process DuckDB with the merge table ``merges(pair, m)``:
two adjacent token ids and the id (= rank) of their concatenation. Both tables
are built once and broadcast. All words become rows ``(w, pos, id)``, one per byte. A recursive query joins adjacent rows with
the merge table, contracts each word's leftmost minimum-rank pair and repeats
until no word has a pair left; decoding joins ids with the token table and
concatenates the bytes in the order of their positions. Words of over ``SHORT`` bytes
contract every leftmost non-overlapping pair of the minimum rank per step (a
merged token only takes part in later ranks, so the result is the same).

Spark partitions the documents; a task encodes each distinct unit once, while
it stays in the task's bounded cache (``pretokens.Cache``). No shuffle, no
collect. Every token must be reachable by its merges, as in every vocabulary
that byte-pair training gives (tested for the one used here).

Defined cases: null text is empty; an empty text has 0 tokens and the SHA-256
of the empty string; a very long text is a slice of its own, and a very long
word costs a query per ``ROUNDS`` ranks (seconds for 10 kB); repeated rows give
repeated rows; there are no ties (the leftmost pair of the least rank goes
first); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import doc_columns, slices, strings, task, text_bytes
from .pretokens import Cache, Units

#: words of up to SHORT bytes go together, ROWS bytes at once; longer words are contracted ROUNDS deep at a time
SHORT, ROWS, ROUNDS = 64, 250_000, 24

SHORT_SQL = """
with recursive t(w, pos, id, live) as (
  select w, pos, id, true from start
  union all
  (with p as (
     select w, pos, id, lead(id) over o next_id, lead(w) over o next_w, lead(pos) over o next_pos
     from t where live window o as (order by pos)),
   pairs as (
     select p.w, p.pos, p.next_pos, m.m::bigint * 4294967296 + p.pos as key
     from p join merges m on m.pair = p.id::bigint * 65536 + p.next_id where p.next_w = p.w),
   best as (select w, min(key) as key, arg_min(next_pos, key) as next_pos from pairs group by w)
   select p.w, p.pos, case when best.key & 4294967295 = p.pos then (best.key >> 32)::int else p.id end,
          best.w is not null
   from p left join best on best.w = p.w
   where best.w is null or best.next_pos <> p.pos)
)
select w, id::varchar ids, hex from t join tokens using (id) where not live order by pos"""

LONG_SQL = f"""
with recursive t(w, pos, id, live, round) as (
  select w, pos, id, true, 0 from start
  union all
  (with p as (
     select w, pos, id, round, row_number() over o n,
            lead(id) over o next_id, lead(w) over o next_w, lead(pos) over o next_pos
     from t where live and round < {ROUNDS} window o as (order by pos)),
   pairs as (
     select p.w, p.pos, p.next_pos, p.n, m.m
     from p join merges m on m.pair = p.id::bigint * 65536 + p.next_id where p.next_w = p.w),
   best as (select w, min(m) m from pairs group by w),
   hits as (
     select pairs.*, n - row_number() over (order by n) run
     from pairs join best on best.w = pairs.w and best.m = pairs.m),
   taken as (
     select *, row_number() over (partition by run order by n) % 2 = 1 odd from hits)
   select p.w, p.pos, coalesce(a.m, p.id), best.w is not null, p.round + 1
   from p
   left join (select pos, m from taken where odd) a on a.pos = p.pos
   left join (select next_pos from taken where odd) b on b.next_pos = p.pos
   left join best on best.w = p.w
   where b.next_pos is null)
)
select w, pos, id, live from t where not live or round = {ROUNDS} order by pos"""

DECODE_SQL = """
select w, string_agg(id, ' ' order by pos) ids, string_agg(hex, '' order by pos) hex
from coded join tokens using (id) group by w order by w"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one ``base64(token) rank`` line per token."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def vocabulary(path: str) -> tuple[bytes, bytes]:
    """The merge table (pair, m) and the token table (id, hex) of a rank file as Arrow streams.

    Built once on the driver; their size is that of the vocabulary, whatever the corpus.
    """
    ranks = read_ranks(path)
    pairs = [(a * 65536 + b, m) for t, m in ranks.items() for i in range(1, len(t))
             if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None]
    merges = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()),
                       "m": pa.array([m for _, m in pairs], pa.int32())})
    tokens = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])})
    return _stream(merges), _stream(tokens)


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _joined(rows: pa.Table, n: int) -> pa.Table:
    """One row per word 0 to n - 1 of its tokens' rows, which come in order: ids joined by a space, hex by nothing."""
    ends = pa.array(np.searchsorted(rows["w"].combine_chunks(), np.arange(n + 1)), pa.int32())
    return pa.table({c: pc.binary_join(pa.ListArray.from_arrays(ends, rows[c].combine_chunks()), sep)
                     for c, sep in (("ids", " "), ("hex", ""))})


class ByteBPE:
    """Encoder and decoder of one vocabulary (a rank file or its tables); lives as long as a task."""

    def __init__(self, source: str | tuple[bytes, bytes], pattern: str):
        import duckdb
        import regex
        self.find = regex.compile(pattern).findall
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        for name, stream in zip(("merges", "tokens"), vocabulary(source) if isinstance(source, str) else source):
            self._load(name, pa.ipc.open_stream(stream).read_all())
        single = self.con.sql("select id, hex from tokens where length(hex) = 2").to_arrow_table()
        self.byte_id = np.zeros(256, np.int32)
        self.byte_id[[int(h, 16) for h in single["hex"].to_pylist()]] = np.asarray(single["id"])
        self.cache = Cache(self._units)

    def _load(self, name: str, table: pa.Table) -> None:
        self.con.register("loading", table)
        self.con.execute(f"create table {name} as select * from loading")
        self.con.unregister("loading")

    def _query(self, sql: str, name: str, table: pa.Table) -> pa.Table:
        self.con.register(name, table)
        try:
            return self.con.sql(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def _start(self, raw: np.ndarray, sizes: np.ndarray) -> pa.Table:
        """One row per byte of the words that lie one after another in ``raw``."""
        w = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        return pa.table({"w": w, "pos": np.arange(len(raw), dtype=np.int32), "id": self.byte_id[raw]})

    def _contract_long(self, raw: np.ndarray) -> pa.Table:
        live, done = self._start(raw, np.array([len(raw)])), []
        while live.num_rows:
            got = self._query(LONG_SQL, "start", live)
            done.append(got.filter(pc.invert(got["live"])).drop_columns("live"))
            live = got.filter(got["live"]).drop_columns("live")
        return self._query(DECODE_SQL, "coded", pa.concat_tables(done))

    def encode(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(ids as text, hex of the bytes decoded from them) of each pre-token, in order; no word may be empty."""
        raw, offsets = text_bytes(words)
        sizes = np.diff(offsets)
        short = np.flatnonzero(sizes <= SHORT)
        order, parts = [short], []
        ends = np.cumsum(sizes[short])
        start = 0
        while start < len(short):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + ROWS, side="right")))
            some = short[start:stop]
            at = np.repeat(offsets[some] - np.concatenate([[0], ends[start:stop - 1] - before]), sizes[some])
            bytes_of = raw[at + np.arange(len(at))]
            parts.append(_joined(self._query(SHORT_SQL, "start", self._start(bytes_of, sizes[some])), len(some)))
            start = stop
        for i in np.flatnonzero(sizes > SHORT):
            order.append([i])
            parts.append(self._contract_long(raw[offsets[i]:offsets[i + 1]]))
        if not parts:
            return pa.array([], pa.string()), pa.array([], pa.string())
        back = pa.array(np.argsort(np.concatenate(order).astype(np.int64), kind="stable"))
        return tuple(pa.concat_arrays([p[c].combine_chunks() for p in parts]).take(back) for c in ("ids", "hex"))

    def encode_words(self, words: list[str]) -> list[tuple[str, str]]:
        return list(zip(*(x.to_pylist() for x in self.encode(pa.array(words, pa.large_string())))))

    def decode(self, coded: list[list[int]]) -> list[bytes]:
        """Bytes of each id sequence: tokens joined in position order."""
        ids = np.array([x for c in coded for x in c], np.int32)
        table = pa.table({"w": np.repeat(np.arange(len(coded), dtype=np.int32), [len(c) for c in coded]),
                          "pos": np.arange(len(ids), dtype=np.int32), "id": ids})
        got = self._query(DECODE_SQL, "coded", table)
        hexed = dict(zip(got["w"].to_pylist(), got["hex"].to_pylist()))
        return [bytes.fromhex(hexed.get(i, "")) for i in range(len(coded))]

    def _units(self, units: list[str]) -> list[tuple[str, str]]:
        """(ids joined by one space, hex of the bytes decoded from them) of each unit, whose words are encoded one by one."""
        words = [self.find(u) for u in units]
        ends = np.cumsum([0, *map(len, words)])
        ids, hexed = self.encode(pa.array(list(chain.from_iterable(words)), pa.large_string()))
        if ends[-1] != len(words):                     # units of several words (none of no word: they hold text)
            ids, hexed = (pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x), sep)
                          for x, sep in ((ids, " "), (hexed, "")))
        return list(zip(ids.to_pylist(), hexed.to_pylist()))

    def encode_texts(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(ids joined by one space, bytes decoded from them) of each text."""
        units = Units(texts)
        coded = self.cache.look_up(units.distinct)
        ids, hexed = (pa.array([c[i] for c in coded], pa.string()) for i in (0, 1))
        decoded = [bytes.fromhex(h) for h in units.join(hexed, "").to_pylist()]
        return units.join(ids, " "), pa.array(decoded, pa.binary())


#: text bytes encoded at once
BPE_SLICE = 2 << 20
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_encode(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Per document: token count and digests of the ids and of the decoded bytes.

    ``keep_ids`` adds the ids (array<int>) and the decoded text as columns.
    """
    schema = SCHEMA + (", ids array<int>, decoded string" if keep_ids else "")
    tables = docs.sparkSession.sparkContext.broadcast(vocabulary(path))      # as large as the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE(tables.value, pattern)
        for batch in slices(batches, limit=BPE_SLICE):
            ids, decoded = bpe.encode_texts(strings(batch.column(1)))
            n = np.asarray(pc.count_substring(ids, " ")) + (np.asarray(pc.binary_length(ids)) > 0)
            arrays = [batch.column(0), pa.array(n.astype(np.int64)),
                      pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in ids], pa.string()),
                      pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in decoded], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                arrays += [pa.array([[int(i) for i in x.split()] for x in ids.to_pylist()], pa.list_(pa.int32())),
                           pa.array([x.decode() for x in decoded.to_pylist()], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)
        bpe.con.close()

    return doc_columns(docs).mapInArrow(task(run), schema)
