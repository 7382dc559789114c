"""Token ids in byte-aligned variable-length coding, ranked by frequency, written in document order."""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from plumbline.session import cut_to, drop, scratch

# Where byte-level BPE parts a text before it merges, and its printable characters for bytes.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b for b in _PRINTABLE} | {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}

#: Control byte -> bytes of its four values; two bits a value, lowest first.
LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.uint8)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public vocabulary of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values; the last control byte is filled with zero bits."""
    control, _, data, _ = pack_rows(values, np.array([len(values)]))
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values: control bytes give all lengths through one table, lengths give offsets."""
    return unpack_rows(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), np.array([n]))


def pack_rows(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control, its bytes a row, data, its bytes a row) of rows of ``n`` values each, one after another."""
    v = np.ascontiguousarray(values, "<u4")
    quads = -(-n // 4)
    extra, width = np.zeros(len(v), np.uint8), 2 if v.max(initial=0) <= 0xFFFF else 4
    for k in range(1, width):
        extra += v > (1 << 8 * k) - 1
    bits = np.zeros(int(quads.sum()) * 4, np.uint8)
    bits[_filled(n, quads)] = extra
    control = bits[0::4] | bits[1::4] << 2 | bits[2::4] << 4 | bits[3::4] << 6
    use = np.empty((len(v), width), bool)
    for k in range(width):
        use[:, k] = extra >= k
    ends = np.cumsum(extra, dtype=np.int64)[np.cumsum(n) - 1] if len(v) else np.zeros(len(n), np.int64)
    ends = np.where(np.cumsum(n) > 0, ends, 0) + np.cumsum(n)
    return control, quads, v.view(np.uint8).reshape(-1, 4)[:, :width][use], np.diff(ends, prepend=0)


def unpack_rows(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The values of rows of ``n`` values each, whose control and data bytes stand one after another."""
    size = LENGTHS[control].reshape(-1)[_filled(n, -(-n // 4))]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.concatenate([data, np.zeros(3, np.uint8)])
    out = raw[at].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _filled(n: np.ndarray, quads: np.ndarray) -> np.ndarray:
    """Where the values of rows stand when each row is filled up to whole fours."""
    before = np.cumsum(quads * 4 - n) - (quads * 4 - n)
    return np.arange(int(n.sum())) + np.repeat(before, n)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each range, one range after another."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` in all, a larger row alone."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, bytes a row) of a binary column without NULLs."""
    wide = pa.types.is_large_binary(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    return np.frombuffer(held, np.uint8)[at[0]:at[-1]] if held else np.zeros(0, np.uint8), np.diff(at)


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(flat, np.uint8))])


#: Byte -> the printable character that stands for it; 255 is in no UTF-8 and parts pieces.
_SHOWN = np.array([_BYTES[b] for b in range(256)], "<u2")
_STOPS = frozenset(".,;:!?")


class _Words:
    """ids of texts through the words between their single spaces; byte-level BPE never merges across pieces.

    A piece never reaches over a single space between other characters, so a distinct word is parted and merged once.
    Words stay known in a compact table; when it holds more than ``most``, those of the latest run stay.
    """

    def __init__(self, tokenizer, kind: str, most: int = 400_000):
        self.model, self.kind, self.code, self.most = tokenizer.model, kind, {"<u2": "H", "<u4": "I"}[kind], most
        self.words, self.flat, self.size = pa.array([], pa.string()), np.zeros(0, kind), np.zeros(0, np.int64)

    def merged(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of each piece, from the table where it is a space and a known word."""
        every = list(pieces)
        at = np.full(len(every), -1)
        if len(every) * 20 > len(self.words):  # a look-up reads the whole table, which a few merges do not pay for
            found = pc.index_in(pa.array([p[1:] for p in every], pa.string()), value_set=self.words)
            at = np.where([p[0] == " " for p in every], np.asarray(pc.fill_null(found, -1)), -1)
            at[np.append(self.size, 1)[at] == 0] = -1
        old = np.flatnonzero(at >= 0)
        end = np.cumsum(self.size)[at[old]]
        spans = zip(old.tolist(), (end - self.size[at[old]]).tolist(), end.tolist())
        out = {every[k]: self.flat[a:b].tobytes() for k, a, b in spans}
        new = [every[k] for k in np.flatnonzero(at < 0).tolist()]
        if new:
            raw = np.frombuffer("\udcff".join(new).encode("utf-8", "surrogateescape"), np.uint8)
            tokenize, code = self.model.tokenize, self.code
            for p, shown in zip(new, _SHOWN[raw].tobytes().decode("utf-16-le").split(chr(255))):
                out[p] = array(code, [t.id for t in tokenize(shown)]).tobytes()
        return out

    def joined(self, rows: list[list[str]]) -> list[bytes]:
        """The ids of each row of pieces."""
        ids = self.merged(set().union(*rows))
        return [b"".join([ids[p] for p in row]) for row in rows]

    def after_space(self, words: list[str]) -> list[bytes]:
        """The ids of a space and each word; none where white space stands at the word's edge."""
        lead, stops, parted = [" " + w for w in words], [], {}
        for k, w in enumerate(words):
            if w.isalpha():  # one piece
                continue
            if w[-1:] in _STOPS and w[:-1].isalpha():  # two pieces
                lead[k] = lead[k][:-1]
                stops.append(k)
            else:
                parted[k] = PIECES.findall(lead[k]) if w and not w[0].isspace() and not w[-1].isspace() else []
                lead[k] = "."
        known = self.merged({*lead, *_STOPS}.union(*parted.values()))
        ids = list(map(known.__getitem__, lead))
        for k in stops:
            ids[k] += known[words[k][-1]]
        for k, found in parted.items():
            ids[k] = b"".join([known[p] for p in found])
        return ids

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The places of distinct words in the table, to which the new ones are added."""
        found = pc.index_in(words, value_set=self.words)
        new = np.asarray(pc.is_null(found))
        at = np.asarray(pc.fill_null(found, -1)).astype(np.int64)
        if len(self.words) > self.most:
            stay = at[~new]
            start = (np.cumsum(self.size) - self.size)[stay]
            self.flat = self.flat[_ranges(start, self.size[stay])]
            self.words, self.size = self.words.take(pa.array(stay)), self.size[stay]
            at[~new] = np.arange(len(stay))
        if new.any():
            some = words.filter(pa.array(new))
            ids = self.after_space(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), " ")[0].as_py().split(" "))
            at[new] = len(self.words) + np.arange(len(some))
            self.words = pa.concat_arrays([self.words, some])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), self.kind)])
            self.size = np.concatenate([self.size, np.fromiter(map(len, ids), np.int64, len(ids)) // self.flat.itemsize])
        return at

    def texts(self, column: pa.Array, end: bytes) -> list[bytes]:
        """ids of each text and the end; where white space stands at the edge of a word, the whole text is parted."""
        lists = pc.split_pattern(column.cast(pa.string()), " ")
        at = np.asarray(lists.offsets).astype(np.int64)
        firsts = lists.values.take(pa.array(at[:-1])).to_pylist()
        coded = lists.values.dictionary_encode()
        number = self.numbers(coded.dictionary)[np.asarray(coded.indices)]
        first_ids = self.joined([PIECES.findall(w) if w and not w[-1].isspace() else [] for w in firsts])
        size = np.concatenate([self.size, [len(x) // len(end) for x in first_ids], [1]])
        flat = np.concatenate([self.flat, np.frombuffer(b"".join([*first_ids, end]), self.kind)])
        number[at[:-1]] = len(self.words) + np.arange(len(firsts))
        number = np.insert(number, at[1:], len(size) - 1)
        begin = at[:-1] + np.arange(len(firsts))
        held = size[number]
        whole = np.minimum.reduceat(held, begin) > 0
        laid = flat[_ranges((np.cumsum(size) - size)[number], held)]
        to = np.cumsum(np.add.reduceat(held, begin)).tolist()
        ids = [laid[a:b].tobytes() for a, b in zip([0, *to], to)]
        rest = np.flatnonzero(~whole)
        for k, x in zip(rest, self.joined([PIECES.findall(column[k].as_py()) for k in rest.tolist()])):
            ids[k] = x + end
        return ids


@lru_cache(1)
def _loaded(spec: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    parts = json.loads(spec)
    plain = parts["model"]["type"] == "BPE" and not parts.get("normalizer") and (parts.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not parts["pre_tokenizer"].get("add_prefix_space") and parts["pre_tokenizer"].get("use_regex", True)
    kind = "<u2" if t.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
    return t, _Words(t, kind), plain, [x["content"] for x in parts.get("added_tokens", [])], kind


class _Tokenize:
    """ids of whole texts, in runs of about eight million bytes."""

    def __init__(self, spec: str, end_id: int):
        self.spec, self.end_id = spec, end_id

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, words, plain, added, kind = _loaded(self.spec)
        end = np.array([self.end_id], kind).tobytes()
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for lo, hi in _runs(np.asarray(pc.binary_length(texts)), 1 << 23):
                some = texts.slice(lo, hi - lo)
                ids = words.texts(some, end) if plain else [None] * len(some)
                marked = np.zeros(len(some), bool)
                for a in added:
                    marked |= np.asarray(pc.match_substring(some, a))
                for k in range(len(ids)):
                    if marked[k] or not plain:
                        ids[k] = np.array(t.encode(some[k].as_py(), add_special_tokens=False).ids, kind).tobytes() + end
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


class _Count:
    def __init__(self, kind: str):
        self.kind = kind

    def __call__(self, batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            ids = _flat(b.column(0))[0].view(self.kind) if b.num_rows else np.zeros(0, self.kind)
            for lo in range(0, len(ids), 1 << 20):
                n = np.bincount(ids[lo:lo + (1 << 20)], minlength=len(total))
                n[:len(total)] += total
                total = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])


class _Encode:
    def __init__(self, kind: str, order: np.ndarray, bounds: list[int]):
        self.bounds = np.array(bounds, np.int64)
        self.kind, self.rank = kind, np.zeros(int(order.max(initial=0)) + 1, np.uint32)
        self.rank[order] = np.arange(len(order), dtype=np.uint32)

    def __call__(self, batches):
        width = np.dtype(self.kind).itemsize
        for b in batches:
            part = np.array([0 if d is None else np.searchsorted(self.bounds, d, side="right") for d in b.column(0).to_pylist()], np.int32)
            for lo, hi in _runs(np.asarray(pc.binary_length(b.column(1))), 1 << 21):
                flat, size = _flat(b.column(1).slice(lo, hi - lo))
                n = size // width
                control, c, data, d = pack_rows(self.rank[flat.view(self.kind)], n)
                yield pa.RecordBatch.from_arrays([pa.array(part[lo:hi]), b.column(0).slice(lo, hi - lo), pa.array(n), _binary(control, c), _binary(data, d)], names=["part", "doc_id", "n_tokens", "control", "data"])


def _place(batches):
    """The ids before each row in its file; a task has one file."""
    at = 0
    for b in batches:
        n = np.asarray(b.column(2))
        start = at + np.cumsum(n) - n
        at += int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array(start, pa.int64()), *b.columns], names=["at", *b.schema.names])


class _Decode:
    def __init__(self, order: np.ndarray):
        self.order = order

    def __call__(self, batches):
        for b in batches:
            for lo, hi in _runs(np.asarray(b.column(2)), 1 << 20):
                some = b.slice(lo, hi - lo)
                n = np.asarray(some.column(2))
                ids = self.order[unpack_rows(_flat(some.column(3))[0], _flat(some.column(4))[0], n)].astype("<u4")
                yield pa.RecordBatch.from_arrays([*some.columns[:3], _binary(ids.view(np.uint8), n * 4)], names=["doc_id", "start", "n_tokens", "ids"])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encode every whole text, append ``end_id``, and write ``path``/tokens and ``path``/ranks.

    ``ranks`` lists the ids by falling frequency over all documents (at most the vocabulary; ties by id). In
    ``tokens`` a row is a document: ids are replaced by their ranks, so that frequent ids take one byte; two-bit
    lengths stand apart in ``control``, the bytes in ``data``. Files (``part``) hold ranges of ascending doc_id, rows
    in order; ``at`` counts the ids before a row in its file. A NULL or empty text has the end id only; NULL doc_ids
    stand first; equal doc_ids stand by length, then bytes. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_path) as f:  # a file of the driver's own installation; tasks get its text
        spec = f.read()
    kind = _loaded(spec)[4]
    temp = scratch(spark, "token-ids")
    ids = cut_to(docs.select("doc_id", "text").mapInArrow(_Tokenize(spec, end_id), docs.select("doc_id").schema.add("ids", "binary")), temp, "zstd")
    counts = ids.select("ids").mapInArrow(_Count(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts.orderBy(F.desc("n"), "id").coalesce(1).write.parquet(f"{path}/ranks")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    bounds = ids.select(F.percentile_approx(F.col("doc_id").cast("long"), shares, 20 * max(parts, 500)).alias("b")).head().b if shares else []
    schema = T.StructType([T.StructField("part", T.IntegerType()), *docs.select("doc_id").schema.fields, *T.StructType.fromDDL("n_tokens long, control binary, data binary").fields])
    coded = ids.mapInArrow(_Encode(kind, _order(spark, path), sorted(set(bounds or []))), schema)
    in_order = coded.repartitionById(parts, "part").sortWithinPartitions("doc_id", "n_tokens", "data", "control")
    placed = in_order.mapInArrow(_place, T.StructType([T.StructField("at", T.LongType()), *schema.fields]))
    placed.write.option("compression", "none").parquet(f"{path}/tokens")
    drop(spark, temp)


def _order(spark: SparkSession, path: str) -> np.ndarray:
    """ids by rank; at most one row per id of the vocabulary."""
    rows = spark.read.schema("id long, n long").parquet(f"{path}/ranks").collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], np.int64)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: start counts the ids of all documents before, ids are little-endian 32-bit."""
    rows = spark.read.parquet(f"{path}/tokens")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per file
    base = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    placed = rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "control", "data")
    return placed.mapInArrow(_Decode(_order(spark, path)), placed.select("doc_id", "start", "n_tokens").schema.add("ids", "binary"))


def _checksums(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([zlib.crc32(x.as_py()) for x in b.column(3)], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the token files in the shared folder, read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    back = read_tokens(spark, path)
    return back.mapInArrow(_checksums, back.select("doc_id", "start", "n_tokens").schema.add("ids_crc32", "long"))
