"""Token ids in files of entropy-coded blocks, and their parallel decoding.

``write_tokens`` sorts the documents by id over as many files as the texts need, tokenizes whole texts
with the tokenizers library, appends an end id to each, and keeps the ids of a file in a compressed
stream, while it counts them. One frequency table is made of all counts; then the streams are encoded
with it, file by file. All files are written beside their final place and renamed, so a task that is
tried again replaces them by the same ids.

A folder holds ``table`` (the shared frequencies), ``tokens/<number>.tok`` and a manifest with a row
for each file. All integers are little-endian. A token file is

    segments   one after the other: 64-bit states of the lanes, then 32-bit words (see ``rans``)
    footer     zlib of: bits of the format, table checksum, documents, ids, segments (5 x u64);
               per document its id (i64), whether it has one (u8), its number of ids (u64);
               per segment its offset (u64), first id (u64), ids (u32), lanes (u32), crc32 of its
               bytes (u32), and whether it ends a block (u8)
    trailer    offset of the footer (u64), its length (u32), its crc32 (u32), magic (8 bytes)

``read_tokens`` deals ranges of about ``SPLIT`` ids over tasks; a range decodes the documents that
begin in it, from the checkpoint before the first of them on, segment after segment, and checks every
checksum it passes. Nothing but one segment and one document's running values is held.

Defined results: null texts are empty. Null ids come first, rows that share an id are ordered by a
hash of the text, full repeats are documents of their own. A document without ids (no end id asked
for) begins where the next one does. An empty table has no files. Extra columns are passed over.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..jobs.store import ObjectRoot
from ..session import remove, stored
from . import rans
from .words import pieces, ragged, word_hashes

MAGIC = b"LTOKENS1"
FORMAT = 1
FILE_BYTES = 1 << 25
SPLIT = 1 << 23
MOST_TASKS = 10_000
KNOWN_WORDS = 450_000
PIECE_BYTES = 3 << 20
BLOCK_BYTES = 1 << 19
BLOCK_WORDS = 1 << 16
LOT = 1 << 10
MANIFEST = "file long, name string, docs long, ids long, bytes long"
_SEGMENT = np.dtype([
    ("offset", "<u8"), ("first", "<u8"), ("ids", "<u4"), ("lanes", "<u4"), ("crc", "<u4"), ("final", "u1")])
# The characters with the White_Space property but blank and line end.
_OTHER_BLANK = "\\t\\x0b-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Lines with a word of letters of old standing and marks behind it, which the byte-level split takes apart
# just there; other lines.
_SIMPLE = re.compile(
    rb"^(?:(\0?)((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+)"
    rb"([.,;:!?]*)|.*)$", re.M).findall
# The characters that stand for the bytes in a byte-level vocabulary.
_OTHERS = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTE_CHARS = "".join(chr(256 + _OTHERS.index(b) if b in _OTHERS else b) for b in range(256))


class PieceIds:
    """Ids of texts by the library, each distinct word looked up once.

    A byte-level split of a text breaks at every blank, where a single one goes with the word after it
    and of several the last one does. So words split alike alone and in their text, and ids of a text
    are those of its words. A word is known by its characters where one blank stands before it; after a
    line end it is known with ``\\0`` before it and has the line end's id first. New words of letters, with
    or without marks behind them, go to the library's model as the piece its split makes of them; other
    new words go to the library as one text, with line ends between them, which are ids of their own
    there. Texts with other
    blanks are taken apart more carefully. Other tokenizers get whole texts, and so does every
    tokenizer where a text holds one of its added tokens, which is an end to all blanks.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        if hasattr(self.library.model, "_resize_cache"):
            # Every word comes here once, so the library need not remember any.
            self.library.model._resize_cache(0)
        parsed = json.loads(spec)
        split = parsed.get("pre_tokenizer") or {}
        self.apart = ["\0", *(t["content"] for t in parsed.get("added_tokens") or ())]
        self.line_end = self.whole("\n")
        self.by_word = (
            split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
            and split.get("use_regex", True) and not parsed.get("normalizer")
            and len(self.line_end) == 4)
        self.other_blank = re.compile(f"[{_OTHER_BLANK}]").search
        blank = f"[ \\n{_OTHER_BLANK}]"
        self.pieces = re.compile(
            f"{blank}+(?![^ \\n{_OTHER_BLANK}])| ?[^ \\n{_OTHER_BLANK}]+|{blank}").findall
        model = parsed.get("model") or {}
        self.by_piece = self.by_word and model.get("type") == "BPE" and not model.get("dropout")
        self.marks: dict[bytes, bytes] = {}
        self.known: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        encoding, = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoding.ids, "<u4").tobytes()

    def _is_whole(self, text: str) -> bool:
        return not self.by_word or any(a in text for a in self.apart)

    def _is_plain(self, text: str) -> bool:
        """Whether single blanks and line ends between words are all blanks the text has."""
        return not (
            text[0] in " \n" or text[-1] in " \n"
            or any(two in text for two in ("  ", " \n", "\n ", "\n\n")) or self.other_blank(text))

    def _odd(self, text: str) -> list[bytes]:
        """The words, as they are known, of a text that is not plain."""
        return [
            (piece[1:] if piece[0] == " " and len(piece) > 1 and not piece.isspace()
             # A run of blanks, or a word after another blank.
             else "\0\0" + piece).encode() for piece in self.pieces(text)]

    def _of_model(self, piece: bytes) -> list[int]:
        return [t.id for t in self.library.model.tokenize(charmap_decode(piece, "strict", _BYTE_CHARS)[0])]

    def _learn_simple(self, words: list[bytes]) -> list[bytes]:
        """Looks up the new words that are letters with marks behind them, and returns the others."""
        # Those with other blanks may hold line ends.
        others = [w for w in words if w[:2] == b"\0\0"]
        if others:
            words = [w for w in words if w[:2] != b"\0\0"]
        found, ids, limits = [], [], [0]
        for word, simple in zip(words, _SIMPLE(b"\n".join(words))):
            after_line, letters, marks = simple
            if not letters:
                others.append(word)
                continue
            ids += self._of_model(letters if after_line else b" " + letters)
            limits.append(len(ids))
            found.append(word)
            if marks and marks not in self.marks:
                self.marks[marks] = np.array(self._of_model(marks), "<u4").tobytes()
        packed = np.array(ids, "<u4").tobytes()
        for word, begin, end in zip(found, limits, limits[1:]):
            one = packed[4 * begin:4 * end]
            if word[-1] < 64:
                one += self.marks[word[len(word.rstrip(b".,;:!?")):]]
            self.known[word] = self.line_end + one if word[0] == 0 else one
        return others

    def _learn(self, words: list[bytes]) -> None:
        """Looks up new words."""
        if self.by_piece:
            # In lots, so that few objects wait while the next ones are made.
            words = [w for k in range(0, len(words), LOT) for w in self._learn_simple(words[k:k + LOT])]
        shown = [w.decode() for w in words]
        plain = [w for w in shown if w[:2] != "\0\0" or not w[2:].isspace()]
        for blank in set(shown).difference(plain):
            self.known[blank.encode()] = self.whole(blank[2:])
        if not plain:
            return
        packed = self.whole("\n".join(w.lstrip("\0") if w[0] == "\0" else " " + w for w in plain))
        ends = np.flatnonzero(np.frombuffer(packed, "<u4") == np.frombuffer(self.line_end, "<u4"))
        ends = np.append(ends, len(packed) // 4).tolist()
        if len(ends) != len(plain):
            raise ValueError("the tokenizer does not split at line ends")
        begin = 0
        for word, end in zip(plain, ends):
            ids = packed[4 * begin:4 * end]
            after_line = word[0] == "\0" and word[:2] != "\0\0"
            self.known[word.encode()] = self.line_end + ids if after_line else ids
            begin = end + 1

    def _packed(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words, as they are known."""
        found = list(map(self.known.get, words))
        new = [w for w, ids in zip(words, found) if ids is None]
        if new:
            keep = len(self.known) + len(new) <= KNOWN_WORDS
            self._learn(new)
            found = [self.known[w] if ids is None else ids for w, ids in zip(words, found)]
            if not keep:
                # Words that come first stay: among them are the frequent ones.
                for word in new:
                    del self.known[word]
        return found

    @staticmethod
    def _shown(blob: bytes, start: np.ndarray, stop: np.ndarray, after_line: np.ndarray) -> list[bytes]:
        """Words as they are known."""
        words = [blob[a:b] for a, b in zip(start.tolist(), stop.tolist())]
        for k in np.flatnonzero(after_line).tolist():
            words[k] = b"\0" + words[k]
        return words

    @staticmethod
    def _same(data, start, stop, after_line, other) -> bool:
        """Whether each word has the same bytes as the other one named for it."""
        size = stop - start
        if (size[other] != size).any() or (after_line[other] != after_line).any():
            return False
        return all(
            (data[ragged(start[other[k:k + BLOCK_WORDS]], size[k:k + BLOCK_WORDS])]
             == data[ragged(start[k:k + BLOCK_WORDS], size[k:k + BLOCK_WORDS])]).all()
            for k in range(0, len(start), BLOCK_WORDS))

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of plain texts, which are taken together: every distinct word is looked at once, its
        places are found by a hash and compared byte by byte."""
        blob = b"\n" + b"\n".join(texts)
        data = np.frombuffer(blob, np.uint8)
        # Hashed in blocks of whole lines, so that what that takes stays small.
        found, at = [], 0
        while at < len(blob):
            end = blob.find(b"\n", at + BLOCK_BYTES)
            end = len(blob) if end < 0 else end
            begin, stop, hashes = word_hashes(data[at:end])
            found.append((begin + at, stop + at, hashes))
            at = end
        start, stop, hashes = (np.concatenate(part) for part in zip(*found))
        after_line = data[start - 1] == 10
        hashes[after_line] ^= np.uint64(0x5555555555555555)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if self._same(data, start, stop, after_line, first[which]):
            words = self._shown(blob, start[first], stop[first], after_line[first])
        else:
            # Two words with one hash; not seen so far.
            every = self._shown(blob, start, stop, after_line)
            words = list(dict.fromkeys(every))
            which = np.fromiter(
                map({w: k for k, w in enumerate(words)}.__getitem__, every), np.int64, len(every))
        packed = self._packed(words)
        length = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        begin = np.cumsum(length) - length
        ids = np.frombuffer(b"".join(packed), "<u4")[ragged(begin[which], length[which])]
        # Where the texts' first words are; their line ends are not part of the texts.
        word = np.searchsorted(start, np.cumsum([1, *(len(t) + 1 for t in texts)]))
        limits = np.concatenate([[0], np.cumsum(length[which])])[word]
        return [ids[a + 1:b] for a, b in zip(limits[:-1].tolist(), limits[1:].tolist())]

    def of(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text; null is empty."""
        out: list[np.ndarray] = [np.empty(0, "<u4")] * len(texts)
        plain, odd = [], []
        for k, text in enumerate(texts):
            if text:
                shown = text.decode()
                if self._is_whole(shown):
                    out[k] = np.frombuffer(self.whole(shown), "<u4")
                elif self._is_plain(shown):
                    plain.append(k)
                else:
                    odd.append((k, self._odd(shown)))
        if plain:
            for k, ids in zip(plain, self._plain([texts[k] for k in plain])):
                out[k] = ids
        if odd:
            words = list(dict.fromkeys(w for _, found in odd for w in found))
            packed = dict(zip(words, self._packed(words)))
            for k, found in odd:
                out[k] = np.frombuffer(b"".join(map(packed.__getitem__, found)), "<u4")
        return out


def _ids(sent: Broadcast) -> PieceIds:
    """The worker's tokenizer. It is kept in the broadcast value, which a worker loads once."""
    held = sent.value
    if "ids" not in held:
        held["ids"] = PieceIds(held["spec"])
    return held["ids"]


class FileWriter:
    """Bytes of one token file, from documents that come one after the other."""

    def __init__(self, table: rans.Table):
        self.table = table
        self.keys: list[int | None] = []
        self.sizes: list[int] = []
        self.segments: list[tuple] = []
        self.at = self.written = self.held = 0
        self.waiting: list[np.ndarray] = []

    def _block(self, ids: np.ndarray) -> Iterator[bytes]:
        encoded = list(rans.encode_block(ids, self.table))
        for k, (n, lanes, payload) in enumerate(encoded):
            self.segments.append(
                (self.at, self.written, n, lanes, zlib.crc32(payload), k + 1 == len(encoded)))
            self.at += len(payload)
            self.written += n
            yield payload

    def add(self, key: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= rans.BLOCK:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // rans.BLOCK * rans.BLOCK
            for begin in range(0, whole, rans.BLOCK):
                yield from self._block(ids[begin:begin + rans.BLOCK])
            self.waiting, self.held = [ids[whole:].copy()], len(ids) - whole

    def end(self) -> Iterator[bytes]:
        if self.held:
            yield from self._block(np.concatenate(self.waiting))
        footer = zlib.compress(b"".join([
            struct.pack("<5Q", FORMAT, self.table.checksum, len(self.keys), self.written, len(self.segments)),
            np.array([k or 0 for k in self.keys], "<i8").tobytes(),
            np.array([k is not None for k in self.keys], "u1").tobytes(),
            np.array(self.sizes, "<u8").tobytes(),
            np.array(self.segments, _SEGMENT).tobytes(),
        ]))
        yield footer
        yield struct.pack("<QII", self.at, len(footer), zlib.crc32(footer)) + MAGIC


class FileReader:
    """Documents and id ranges of one token file, given a function that reads (length, offset)."""

    def __init__(self, read_at, size: int, table: rans.Table):
        self.read_at, self.table = read_at, table
        tail = read_at(24, size - 24)
        self.end, length, crc = struct.unpack("<QII", tail[:16])
        footer = read_at(length, self.end)
        if tail[16:] != MAGIC or zlib.crc32(footer) != crc:
            raise ValueError("no token file, or a damaged one")
        footer = zlib.decompress(footer)
        kind, checksum, docs, self.ids, segments = struct.unpack_from("<5Q", footer)
        if kind != FORMAT or checksum != table.checksum:
            raise ValueError("the file belongs to another format or table")
        known = np.frombuffer(footer, "u1", docs, 40 + 8 * docs)
        keys = np.frombuffer(footer, "<i8", docs, 40).tolist()
        self.keys = [k if has else None for k, has in zip(keys, known)]
        sizes = np.frombuffer(footer, "<u8", docs, 40 + 9 * docs).astype(np.int64)
        self.limits = np.concatenate([[0], np.cumsum(sizes)])
        self.segments = np.frombuffer(footer, _SEGMENT, segments, 40 + 17 * docs)
        self._held: tuple[int, np.ndarray] | None = None

    def segment(self, k: int) -> np.ndarray:
        """The ids of one segment; the last one asked for is kept."""
        if self._held is None or self._held[0] != k:
            s = self.segments[k]
            begin = int(s["offset"])
            stop = self.end if k + 1 == len(self.segments) else int(self.segments[k + 1]["offset"])
            payload = self.read_at(stop - begin, begin)
            if zlib.crc32(payload) != s["crc"]:
                raise ValueError("a segment is damaged")
            self._held = k, rans.decode_segment(
                payload, int(s["ids"]), int(s["lanes"]), self.table, bool(s["final"]))
        return self._held[1]

    def span(self, first: int, stop: int) -> Iterator[np.ndarray]:
        """Ids from ``first`` up to ``stop``, in pieces, decoded from the checkpoint before them on."""
        k = int(np.searchsorted(self.segments["first"], first, "right")) - 1
        while first < stop:
            begin = int(self.segments[k]["first"])
            ids = self.segment(k)[first - begin:stop - begin]
            yield ids
            first += len(ids)
            k += 1


def _tokenizing(folder: str, sent: Broadcast, size: int, end: int | None):
    """Writes a partition's ids as a stream of (id, ids), and gives (file, id, n): how often each id
    occurs in it."""
    kind = pa.uint16() if size <= 1 << 16 else pa.uint32()
    schema = pa.schema([("id", pa.int64()), ("ids", pa.large_list(kind))])

    def run(batches):
        ids, counts = _ids(sent), np.zeros(size, np.int64)
        number = TaskContext.get().partitionId()
        tail = np.array([] if end is None else [end], np.uint32)
        rows = 0

        def stream() -> Iterator[bytes]:
            nonlocal counts, rows
            sink = io.BytesIO()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, schema, options=options) as out:
                for piece, texts in pieces(batches, most=PIECE_BYTES):
                    found = [part for one in ids.of(texts) for part in (one, tail)]
                    flat = np.concatenate(found)
                    ends = np.cumsum([0, *(len(a) + len(b) for a, b in zip(found[::2], found[1::2]))])
                    counts += np.bincount(flat, minlength=size)
                    rows += len(texts)
                    lists = pa.LargeListArray.from_arrays(
                        pa.array(ends), pa.array(flat.astype(kind.to_pandas_dtype())))
                    out.write_batch(pa.RecordBatch.from_arrays([piece.column("id"), lists], schema=schema))
                    yield sink.getvalue()
                    sink.seek(0)
                    sink.truncate()
            yield sink.getvalue()

        parts = stream()
        first = next(parts)
        if not rows:
            return
        ObjectRoot(folder).write(f"ids/{number:08d}", chain([first], parts))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found) + 1, number)), pa.array(np.append(-1, found)),
             pa.array(np.append(rows, counts[found]))], ["file", "id", "n"])

    return run


def _encoding(folder: str, table: bytes):
    """Encodes the streams of the files it is given; manifest rows."""
    def run(batches):
        root, made = ObjectRoot(folder), rans.Table.frombytes(table)
        for number in (n for batch in batches for n in batch.column(0).to_pylist()):
            writer, name = FileWriter(made), f"{number:08d}.tok"

            def parts() -> Iterator[bytes]:
                with root.files.open_input_stream(root.path(f"ids/{number:08d}")) as stream:
                    for batch in pa.ipc.open_stream(stream):
                        lists = batch.column("ids")
                        ends = lists.offsets.to_numpy().tolist()
                        flat = lists.values.to_numpy().astype(np.uint32)
                        for key, begin, stop in zip(batch.column("id").to_pylist(), ends, ends[1:]):
                            yield from writer.add(key, flat[begin:stop])
                yield from writer.end()

            size = root.write(f"tokens/{name}", parts())
            yield pa.RecordBatch.from_pydict({
                "file": [number], "name": [name], "docs": [len(writer.keys)], "ids": [writer.written],
                "bytes": [size]})

    return run


def write_tokens(
    docs: DataFrame, folder: str, path: str, end: int | None = None, file_bytes: int = FILE_BYTES,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Writes the ids of all texts, in the order of the documents' ids, and returns the manifest.

    ``path`` names a file of the tokenizers library, ``end`` the id that ends every document. A file
    holds the ids of about ``file_bytes`` of text.
    """
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_str(spec).get_vocab_size(), (end or 0) + 1)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast({"spec": spec})
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    length = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # The row number keeps full repeats, which may be many, from meeting in one file.
    place = rows.withColumns({"place": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("id"), F.col("place"), F.col("nth")]
    in_order = place.repartitionByRange(max(1, -(-length // file_bytes)), *order).sortWithinPartitions(*order)
    counted = stored(in_order.select("id", "text").mapInArrow(
        _tokenizing(folder, sent, size, end), "file long, id long, n long"), "counts")

    counts = np.zeros(size, np.int64)
    for token, n in counted.filter("id >= 0").groupBy("id").agg(F.sum("n")).collect():
        counts[token] = n  # one row for each id of the vocabulary at most
    table = rans.Table(rans.frequencies(counts)).tobytes()
    ObjectRoot(folder).write("table", [table])
    files = counted.filter("id < 0").select("file")
    files.repartition(max(1, files.count())).mapInArrow(
        _encoding(folder, table), MANIFEST).write.parquet(f"{folder}/manifest")
    remove(spark, f"{folder}/ids")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False, split: int = SPLIT) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, token_ids]) of every document, from the files alone.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is that of its ids as unsigned
    32-bit integers, ``token_ids`` are those bytes.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row for each file.
    before = F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    parts = F.greatest(F.lit(1), F.ceil(F.col("ids") / split)).cast("int")
    placed = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    splits = placed.select(
        "name", "bytes", "base", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    tasks = max(1, manifest.agg(F.sum(parts)).first()[0] or 0)
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["token_ids"] * with_ids]

    def run(batches):
        root = ObjectRoot(folder)
        table = rans.Table.frombytes(b"".join(root.chunks("table", 1 << 24)))
        for row in (r for batch in batches for r in batch.to_pylist()):
            with root.files.open_input_file(root.path(f"tokens/{row['name']}")) as file:
                reader = FileReader(file.read_at, row["bytes"], table)
                part = np.minimum(reader.limits[:-1] // split, row["parts"] - 1)
                out: list[list] = [[] for _ in names]
                for k in np.flatnonzero(part == row["part"]).tolist():
                    first, stop = reader.limits[k:k + 2].tolist()
                    crc, kept = 0, []
                    for ids in reader.span(first, stop):
                        packed = ids.astype("<u4").tobytes()
                        crc = zlib.crc32(packed, crc)
                        if with_ids:
                            kept.append(packed)
                    values = (reader.keys[k], row["base"] + first, stop - first, crc, b"".join(kept))
                    for column, value in zip(out, values):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(out, kinds)], names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", token_ids binary" * with_ids
    return splits.repartition(min(tasks, MOST_TASKS)).mapInArrow(run, schema)
