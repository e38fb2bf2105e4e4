"""Token ids as length-delimited binary records with a separate offset index.

A data file holds records one after another:

    length of the payload   unsigned 64-bit little-endian
    masked CRC-32 of these eight bytes   unsigned 32-bit little-endian
    payload                 ids, little-endian, 16 bits each where the vocabulary fits, else 32
    masked CRC-32 of the payload

A checksum c is masked as ((c >> 15) | (c << 17)) + 0xa282ead8 modulo 2^32, so that
checksums stored among checksummed bytes do no harm. The index file begins with the
eight bytes ``TOKIDX`` + width (two digits) and has 24 bytes a record: document id
(signed 64 bits; the least value is null), offset of the record in the data file,
number of ids. A reader can draw records in any order from it.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import bounded, open_fs, saved, work_dir

#: Fixed values of the masking.
MASK_ROTATE, MASK_ADD = 15, 0xA282EAD8
NULL_ID = -(1 << 63)
#: Data files are closed beyond this size.
FILE_BYTES = 256 << 20
#: Pieces of text whose ids a worker remembers, at some 250 bytes a piece.
CACHE = 100_000
#: Bytes of rows that are encoded together.
_TOGETHER = 2 << 20
#: Data files that a shuffled reader keeps open.
_OPEN = 64
#: Pieces whose ids are put together at a time.
_GATHERED = 1 << 19
_INDEX = "<qQQ"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> MASK_ROTATE) | (c << (32 - MASK_ROTATE))) + MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(raw: bytes) -> bytes:
    """Payload of one whole record; ValueError if a checksum or the length is wrong."""
    head, payload = raw[:8], raw[12:-4]
    if len(raw) < 16 or struct.unpack("<I", raw[8:12])[0] != masked(head) or struct.unpack("<Q", head)[0] != len(payload) or struct.unpack("<I", raw[-4:])[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


class Encoder:
    """Ids of whole texts, through a memory of the ids of their pieces.

    The tokenizer's splitter begins a new word at the latest where a space follows
    another character than white space, and where letters end; byte-level BPE merges
    inside its words alone. So a text's ids are those of its pieces, put together. The
    library encodes each piece that isn't remembered, many in one text with a newline
    (a word of its own there) between. Pieces are cut, told apart and put together by
    columns; only a batch's distinct pieces are looked up one by one.
    """

    #: A space after white space begins no piece of its own, nor does one that begins a text.
    _odd = "^ |[\t-\r\x1c-\x1f \x85\xa0  -     　] "
    _marks = ".,;:!?|"

    def __init__(self, path: str, width: int):
        self.tokenizer = load_tokenizer(path)
        self.kind = np.dtype("<u2" if width == 16 else "<u4")
        self.known: dict[str, int] = {}
        self.starts: dict[str, int] = {}
        self.tails: dict[str, bytes] = {}
        self.memory = CACHE
        self.pool, self.at, self.size = np.zeros(1 << 16, self.kind), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.entries = self.used = 0
        (self.newline,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.break_ = np.array([self.newline], self.kind).tobytes()

    @classmethod
    def shared(cls, path: str, width: int, memory: int) -> Encoder:
        """The worker's own encoder, which keeps its memory from task to task."""
        if (path, width) not in _encoders:
            _encoders[path, width] = cls(path, width)
        _encoders[path, width].memory = memory
        return _encoders[path, width]

    @staticmethod
    def _strict(text: str) -> list[str]:
        """Pieces of a text with spaces at its start or after white space; these stay in the piece before."""
        out = [""]
        for k, x in enumerate(text.split(" ")):
            if k and out[-1] and not out[-1][-1].isspace():
                out.append(" " + x)
            else:
                out[-1] += " " + x if k else x
        return [out[0], *(x[1:] for x in out[1:])]

    def _raw(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and ids.max() > np.iinfo(self.kind).max:
            raise ValueError(f"id {ids.max()} does not fit {8 * self.kind.itemsize} bits")
        return ids.astype(self.kind).tobytes()

    def _ids(self, new: list[str]) -> dict[str, bytes]:
        """Ids of pieces, with their spaces."""
        out = {}
        plain, odd = [], []
        for p in new:
            # One word, led by a character of white space other than a newline at most.
            (plain if len(x := p.split()) == 1 and len(x[0]) >= len(p) - 1 and p[0] != "\n" and not p[-1].isspace() else odd).append(p)
        for i in range(0, len(plain), 2048):
            part = plain[i : i + 2048]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids)
            cuts = np.flatnonzero(ids == self.newline)
            if len(cuts) != len(part) - 1:
                odd += part
                continue
            raw, size = self._raw(ids), self.kind.itemsize
            starts, stops = [0, *((cuts + 1) * size).tolist()], [*(cuts * size).tolist(), len(raw)]
            out.update(zip(part, map(raw.__getitem__, map(slice, starts, stops)), strict=True))
        for i in range(0, len(odd), 1024):
            part = odd[i : i + 1024]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                out[p] = self._raw(e.ids)
        return out

    def _bytes(self, entry: int) -> bytes:
        return self.pool[self.at[entry] : self.at[entry] + self.size[entry]].tobytes()

    def _learnt(self, new: list[str]) -> list[bytes]:
        """Ids of pieces that a space leads.

        Words that a mark ends share the ids of the word. A newline between two words is
        a word of its own, so such a piece is put together from three.
        """
        known, marks = self.known, self._marks
        words, ended, lines = {}, {}, {}
        for p in new:
            if "\n" in p and len(x := p.split("\n")) == 2 and all(x) and len(p.split()) == 2 and not any(map(str.isspace, x[0] + x[1])):
                lines[p] = x
            elif (w := p.rstrip(marks)) != p and w[-1:].isalpha():
                ended[p] = w
                words[w] = None
            else:
                words[p] = None
        for a, _ in lines.values():
            if (w := a.rstrip(marks)) != a and w[-1:].isalpha():
                ended[a] = w
                words[w] = None
            else:
                words[a] = None
        wanted = [w for w in words if w not in known]
        tails = list({p[len(w) :] for p, w in ended.items()} - self.tails.keys())
        found = self._ids([" " + w for w in wanted] + tails)
        for t in tails:
            self.tails[t] = found[t]
        for w in words:
            words[w] = self._bytes(known[w]) if w in known else found[" " + w]
        for p, w in ended.items():
            words[p] = words[w] + self.tails[p[len(w) :]]
        if lines:
            second = list({b for _, b in lines.values()})
            start = dict(zip(second, map(self._bytes, self._started(second)), strict=True))
            for p, (a, b) in lines.items():
                words[p] = words[a] + self.break_ + start[b]
        return list(map(words.__getitem__, new))

    def _added(self, raws: list[bytes]) -> range:
        """Entries of new ids in the pool."""
        ids = np.frombuffer(b"".join(raws), self.kind)
        sizes = np.fromiter(map(len, raws), np.int64, len(raws)) // self.kind.itemsize
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        while self.entries + len(raws) > len(self.at):
            self.at, self.size = np.append(self.at, np.zeros_like(self.at)), np.append(self.size, np.zeros_like(self.size))
        a, b = self.entries, self.entries + len(raws)
        self.pool[self.used : self.used + len(ids)] = ids
        self.at[a:b], self.size[a:b] = self.used + np.cumsum(sizes) - sizes, sizes
        self.entries, self.used = b, self.used + len(ids)
        return range(a, b)

    def _looked_up(self, pieces: list[str], known: dict[str, int], learn, room: int) -> np.ndarray:
        """Entries of distinct pieces; new ones are remembered while there is room: what is frequent is met early."""
        found = np.array(list(map(known.get, pieces, repeat(-1))), np.int64)
        gaps = np.flatnonzero(found < 0)
        if len(gaps):
            new = list(map(pieces.__getitem__, gaps.tolist()))
            entries = self._added(learn(new))
            known.update(zip(new[: max(0, room - len(known))], entries, strict=False))
            found[gaps] = np.arange(entries.start, entries.stop)
        return found

    def _started(self, pieces: list[str]) -> list[int]:
        """Entries of distinct pieces that no space leads."""

        def learn(new):
            ids = self._ids(new)
            return [ids[p] for p in new]

        return self._looked_up(pieces, self.starts, learn, self.memory // 4).tolist()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; where each begins, and the end), without special ones. Null counts as empty."""
        if len(self.tails) > self.memory:
            self.tails.clear()
        column = column.cast(pa.large_string()).fill_null("")
        lists = pc.split_pattern(column, " ")
        flat, cuts = lists.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
        odd = np.flatnonzero(pc.match_substring_regex(column, self._odd).to_numpy(zero_copy_only=False))
        if len(odd):
            parts, last, counts = [], 0, np.diff(cuts)
            for k in odd.tolist():
                strict = self._strict(column[k].as_py())
                parts += [flat.slice(cuts[last], cuts[k] - cuts[last]), pa.array(strict, pa.large_string())]
                counts[k], last = len(strict), k + 1
            flat, cuts = pa.concat_arrays([*parts, flat.slice(cuts[last])]), np.concatenate(([0], np.cumsum(counts)))
        told = flat.dictionary_encode()
        heads = cuts[:-1]  # a text has one piece at least
        where = told.indices.to_numpy(zero_copy_only=False)
        rest = np.ones(len(where), bool)
        rest[heads] = False
        led = np.unique(where[rest])
        words, firsts = told.dictionary, np.unique(where[heads])
        of = np.zeros(len(words), np.int64)
        of[led] = self._looked_up(words.take(pa.array(led)).to_pylist(), self.known, self._learnt, self.memory)
        entry = of[where]
        of[firsts] = self._started(words.take(pa.array(firsts)).to_pylist())
        entry[heads] = of[where[heads]]

        size = self.size[entry]
        ends = np.cumsum(size)
        out = np.empty(int(ends[-1]) if len(ends) else 0, self.kind)
        for a in range(0, len(entry), _GATHERED):
            part, n = entry[a : a + _GATHERED], size[a : a + _GATHERED]
            begin = int(ends[a] - size[a])
            stop = int(ends[min(a + _GATHERED, len(ends)) - 1])
            out[begin:stop] = self.pool[np.repeat(self.at[part] - (ends[a : a + _GATHERED] - n - begin), n) + np.arange(stop - begin)]
        bounds = np.append(0, ends)[cuts]
        if self.entries > 2 * self.memory:
            self._forget()
        return out, bounds

    def _forget(self) -> None:
        """Ids of pieces that are not remembered leave the pool."""
        kept = np.fromiter([*self.known.values(), *self.starts.values()], np.int64)
        size = self.size[kept]
        ends = np.cumsum(size)
        pool = self.pool[np.repeat(self.at[kept] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        place = np.empty(self.entries, np.int64)
        place[kept] = np.arange(len(kept))
        for names in (self.known, self.starts):
            names.update(zip(names, place[np.fromiter(names.values(), np.int64, len(names))].tolist(), strict=True))
        self.at[: len(kept)], self.size[: len(kept)] = ends - size, size
        self.pool[: len(pool)] = pool
        self.entries, self.used = len(kept), len(pool)


_encoders: dict[tuple[str, int], Encoder] = {}


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of several batches, of _TOGETHER bytes or little more."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= _TOGETHER:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _written(folder: str, tokenizer: str, width: int, end_id: int, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, base = open_fs(folder)
        encoder = Encoder.shared(tokenizer, width, memory)
        end = np.array([end_id], encoder.kind).tobytes()
        shard, done = TaskContext.get().partitionId(), []
        data = index = path = None
        size = n = tokens = 0

        def close():
            data.close()
            index.close()
            done.append((path, shard, len(done), n, tokens, size))

        for rows in _runs(batches):
            ids, bounds = encoder.encode(rows.column(1).combine_chunks())
            for doc, a, b in zip(rows.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if data is None:
                    path = f"{base}/{shard:06d}-{uuid.uuid4().hex}.tok"
                    data, index = fs.open_output_stream(path, compression=None), fs.open_output_stream(path + ".idx", compression=None)
                    index.write(b"TOKIDX%02d" % width)
                    size = n = tokens = 0
                raw = frame(ids[a:b].tobytes() + end)
                data.write(raw)
                index.write(struct.pack(_INDEX, NULL_ID if doc is None else doc, size, b - a + 1))
                size, n, tokens = size + len(raw), n + 1, tokens + b - a + 1
                if size >= FILE_BYTES:
                    close()
                    data = None
        if data is not None:
            close()
        pa.default_memory_pool().release_unused()  # the worker may stay for other tasks
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], ["path", "shard", "part", "records", "tokens", "bytes"])

    return run


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, memory: int = CACHE) -> DataFrame:
    """Encode every whole text and write data and index files in ascending order of doc_id; returns the manifest.

    Manifest: path (of the data file; its index has ``.idx`` after it), shard, part,
    records, tokens, bytes, start (ids in all files before). ``end_id`` closes each
    document. Files of one shard, and shards, follow one another in order of doc_id.
    ``memory`` bounds the pieces of text whose ids a worker remembers.
    Names are new in each attempt of a task and the manifest names only those that count.

    Ids have 16 bits where the tokenizer's vocabulary and ``end_id`` fit, else 32; an id
    that does not fit raises ValueError.
    Null texts count as empty, null ids come first; documents of one id are ordered by
    a hash of their texts. Other columns are not read. An empty table gives no files.
    """
    width = 16 if max(load_tokenizer(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 32
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = saved(rows.mapInArrow(_written(folder, tokenizer, width, end_id, memory), "path string, shard long, part long, records long, tokens long, bytes long"), "token-files")
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def _index(fs, path: str) -> tuple[int, np.ndarray]:
    """Width of the ids, and (document id, offset, number of ids) of each record, of a data file's index."""
    with fs.open_input_stream(path + ".idx", compression=None) as f:
        raw = f.read()
    if raw[:6] != b"TOKIDX" or (len(raw) - 8) % struct.calcsize(_INDEX):
        raise ValueError(f"{path}.idx is no index")
    return int(raw[6:8]), np.frombuffer(raw, np.dtype([("id", "<i8"), ("offset", "<u8"), ("count", "<u8")]), offset=8)


def _payload(file, offset: int, count: int, width: int) -> np.ndarray:
    file.seek(offset)
    return np.frombuffer(unframe(file.read(count * width // 8 + 16)), f"<u{width // 8}")


def _ids_of(index: np.ndarray) -> pa.Array:
    return pa.array(index["id"], pa.int64(), mask=index["id"] == NULL_ID)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                width, index = _index(fs, path)
                counts = index["count"].astype(np.int64)
                with fs.open_input_file(path) as f:
                    # The file is read once, from end to end, and each record is taken where the index says.
                    sums = []
                    for a, stop in _spans(index, width):
                        base = int(index["offset"][a])
                        f.seek(base)
                        block = memoryview(f.read(int(index["offset"][stop - 1]) + int(counts[stop - 1]) * width // 8 + 16 - base))
                        for at, count in zip(index["offset"][a:stop].tolist(), counts[a:stop].tolist(), strict=True):
                            raw = bytes(block[at - base : at - base + count * width // 8 + 16])
                            sums.append(zlib.crc32(np.frombuffer(unframe(raw), f"<u{width // 8}").astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([_ids_of(index), pa.array(start + np.cumsum(counts) - counts), pa.array(counts), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def _spans(index: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Runs of records of some _TOGETHER bytes, one record at least."""
    ends = index["offset"].astype(np.int64) + index["count"].astype(np.int64) * (width // 8) + 16
    a = 0
    while a < len(index):
        stop = max(a + 1, int(np.searchsorted(ends, int(index["offset"][a]) + _TOGETHER, side="right")))
        yield a, stop
        a = stop


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Read all files of a manifest: doc_id, start (ids of all documents before), n_tokens, ids_crc32 (of the ids as unsigned 32 bits).

    Every checksum is held against its bytes; a damaged record ends the job.
    """
    parts = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    rows = manifest.select("path", "start").repartition(parts, "path")
    return rows.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _listed(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                width, index = _index(fs, path)
                n = len(index)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n), _ids_of(index), pa.array(index["offset"].astype(np.int64)), pa.array(index["count"].astype(np.int64)), pa.array([width] * n, pa.int32())], ["path", "doc_id", "offset", "n_tokens", "width"])

    return run


def _drawn(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        files: dict = {}
        try:
            for batch in batches:
                ids = []
                for path, offset, count, width in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True):
                    if path not in files:
                        if len(files) >= _OPEN:
                            files.pop(next(iter(files))).close()
                        files[path] = fs.open_input_file(path)
                    ids.append(_payload(files[path], offset, count, width).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])
        finally:
            for f in files.values():
                f.close()

    return run


def offset_index(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of a manifest's files, from their index files alone: path, doc_id, offset, n_tokens, width."""
    parts = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.select("path").repartition(parts, "path").mapInArrow(_listed(folder), "path string, doc_id long, offset long, n_tokens long, width int")


def shuffled(index: DataFrame, folder: str, seed: int) -> DataFrame:
    """Records in a random order that the seed decides: (doc_id, ids), in partitions that follow one another in that order.

    Only rows of the offset index are shuffled; each record is then read at its offset
    and held against its checksums. ``index`` is that of ``offset_index`` or rows of it.
    """
    order = (F.xxhash64("path", "offset", F.lit(seed)), "path", "offset")
    rows = bounded(index).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("doc_id", "path", "offset", "n_tokens", "width").mapInArrow(_drawn(folder), "doc_id long, ids array<long>")


def round_trip(docs: DataFrame, tokenizer: str, memory: int = CACHE) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    folder = work_dir(spark, "tokens")
    return read_records(write_records(docs, folder, tokenizer, memory=memory), folder)
