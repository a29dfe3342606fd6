"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here; normaliser, metaspace marker, scores and
byte fallback are rebuilt as a ``tokenizers`` tokenizer. A unigram model keeps its
scores, a BPE model's scores become the order of its merges. Texts are cut before
runs of spaces (checked to be exact for the vocabulary), each distinct part of a block is
encoded once in multithreaded calls (threads as many as ``spark.task.cpus``), and the ids are put
together by index. The sentencepiece library then encodes the whole raw texts, and all ids are
compared (``parity``).

Defined results: a null or empty text has no ids; decoding returns the text as
the model normalises it, with any white space in front that its marker hides; every row gets a
row, whatever its doc_id, null and repeated ones included; a text of any length is encoded whole; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import ranges, text_blocks, text_bytes

MARK = "▁"
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 0x7F) << shift
        shift += 7
        at += 1
        if data[at - 1] < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True
    suffix: bool = False


def parse_model(data: bytes) -> Model:
    """The parts of a model file that encoding and decoding need."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(_fields(value))
            model.kind, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            model.suffix = bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap, model.dummy_prefix = spec.get(2, b""), bool(spec.get(3, 1))
            model.trim_spaces, model.escape_spaces = bool(spec.get(4, 1)), bool(spec.get(5, 1))
    if model.kind not in (UNIGRAM, BPE) or model.suffix or not model.escape_spaces:
        raise ValueError("only unigram and BPE models with a marker in front are supported")
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first."""
    usable = {p: s for p, s, kind in model.pieces if kind == NORMAL}
    out = []
    for piece, score in usable.items():
        for cut in range(1, len(piece)):
            if piece[:cut] in usable and piece[cut:] in usable:
                out.append((-score, usable[piece[:cut]], piece[:cut], piece[cut:]))
    out.sort(key=lambda m: (m[0], -m[1]))
    return [(a, b) for _, _, a, b in out]


class Encoder:
    """Encoder and decoder of a parsed model; texts go in whole."""

    def __init__(self, model: Model):
        from tokenizers import Regex, Tokenizer, models, normalizers

        self.model = model
        names = [p for p, _, _ in model.pieces]
        kinds = np.array([k for _, _, k in model.pieces])
        unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        if model.kind == BPE:
            core = models.BPE(vocab={p: i for i, p in enumerate(names)}, merges=_merges(model), cache_capacity=0,
                              unk_token=names[unknown], fuse_unk=True, byte_fallback=model.byte_fallback)
        else:
            core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
        self.tokenizer = Tokenizer(core)
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.trim_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        self.normalizer = normalizers.Sequence(steps) if steps else None
        # exact if no piece has the marker behind another character
        self.parted = not any(MARK in p.lstrip(MARK) for p in names)
        self.parts = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.bytes = np.full(len(names), -1, np.int16)
        for i in np.flatnonzero(kinds == BYTE):
            self.bytes[i] = int(names[i][1:-1], 16)
        self.surface = [b"" if k == CONTROL else p.replace(MARK, " ").encode() for p, _, k in model.pieces]
        self.surface[unknown] = " ⁇ ".encode()

    def normalized(self, text: str) -> str:
        """The text as the model sees it, spaces as markers."""
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _ids(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def encode(self, texts: list[str], check=None) -> tuple[list[list[int]], list[bool]]:
        """Ids of each text, and whether ``check`` (a sentencepiece processor) agrees on all its parts."""
        cut = [self.parts.findall(t) if self.parted else [t] * bool(t) for t in map(self.normalized, texts)]
        distinct = list({p for parts in cut for p in parts})
        known = dict(zip(distinct, self._ids(distinct)))
        wrong = self.disagreeing(known, check) if check is not None else set()
        return ([[i for p in parts for i in known[p]] for parts in cut],
                [not any(p in wrong for p in parts) for parts in cut] if wrong else [True] * len(cut))

    def disagreeing(self, known: dict[str, list[int]], check) -> set[str]:
        """Parts to which ``check`` gives other ids. The library adds the marker in front
        itself, but not to an empty text; a part without one in front is not asked for."""
        front = self.model.dummy_prefix
        asked = [p for p in known if p[0] == MARK or not front]
        plain = [p[front:].replace(MARK, " ") for p in asked]
        return {p for p, ids in zip(asked, check.encode(plain, num_threads=1))
                if (ids or [check.piece_to_id(p)]) != known[p]}

    def bytes_of(self, ids: list[int]) -> bytes:
        """What ids stand for, markers as spaces."""
        return b"".join(bytes([b]) if (b := int(self.bytes[i])) >= 0 else self.surface[i] for i in ids)

    def text_of(self, data: bytes) -> str:
        """Text of a decoded whole; bytes that are no UTF-8 become replacement characters."""
        return data[self.model.dummy_prefix and data.startswith(b" "):].decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        """Text of ids."""
        return self.text_of(self.bytes_of(ids))

    def seen(self, text: str) -> str:
        """What decoding the encoded text must give."""
        text = self.normalized(text).replace(MARK, " ")
        return text[1:] if self.model.dummy_prefix else text


def _encode(data: bytes, threads: int, size: int):
    def run(batches):
        import sentencepiece

        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        parts = Parts(Encoder(parse_model(data)))
        check = sentencepiece.SentencePieceProcessor(model_proto=data)
        for rows, _, _ in text_blocks(batches, size=size):
            yield _encoded(parts, check, rows)
            pa.default_memory_pool().release_unused()
    return run


class Parts:
    """Ids of distinct parts of texts, as the encoder's model gives them."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        names = [p for p, _, _ in encoder.model.pieces]
        self.size = np.array([1 if b >= 0 else len(p.encode()) for p, b in zip(names, encoder.bytes.tolist())])
        # what each id stands for, as ``bytes_of`` gives it
        surface = [encoder.bytes_of([i]) for i in range(len(names))]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_at = np.concatenate(([0], np.cumsum([len(x) for x in surface])))
        # with a byte fallback every id stands for known bytes, so many parts can be encoded in one go
        self.joined = encoder.model.byte_fallback and encoder.parted and encoder.model.kind == BPE

    def cut(self, column: pa.Array):
        """Texts as the model sees them, spaces as spaces: bytes, first byte of each part, first part of each text."""
        front = self.encoder.model.dummy_prefix
        if self.encoder.normalizer is None:
            column = pc.fill_null(column, "")
            seen = pc.if_else(pc.equal(pc.binary_length(column), 0), "", pc.binary_join_element_wise(
                " " if front else "", column, ""))
        else:
            seen = pa.array([self.encoder.normalized(t or "").replace(MARK, " ") for t in column.to_pylist()], pa.string())
        buf, offs = text_bytes(seen)
        begin = np.zeros(len(buf) + 1, bool)
        if self.encoder.parted and len(buf):
            space = buf == 0x20
            begin[1:-1] = space[1:] & ~space[:-1]
            # a marker that stands in the text counts as a space to the model
            mark = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)) + 3
            begin[mark] = False
        begin[offs[:-1]] = True
        starts = np.flatnonzero(begin[:len(buf)])
        return buf, np.append(starts, len(buf)), np.searchsorted(starts, offs)

    def _alone(self, data: bytes, places: list[int]) -> list[np.ndarray]:
        """Ids of each part by itself."""
        texts = [data[a:b].decode().replace(" ", MARK) for a, b in zip(places[:-1], places[1:])]
        return [np.asarray(ids, "<i4") for at in range(0, len(texts), 5_000) for ids in self.encoder._ids(texts[at:at + 5_000])]

    def _groups(self, data: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive parts, many parts in one go, and how many each has."""
        # bytes up to each part's end with spaces as markers
        spaces = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) == 0x20)))
        marked = places + (len(MARK.encode()) - 1) * spaces[places]
        out, counts, n = [], [], len(places) - 1
        for at in range(0, n, 20_000):
            edges = [*range(at, min(at + 20_000, n), 200), min(at + 20_000, n)]
            texts = [data[places[i]:places[j]].decode().replace(" ", MARK) for i, j in zip(edges[:-1], edges[1:])]
            for i, j, ids in zip(edges[:-1], edges[1:], self.encoder._ids(texts)):
                flat = np.asarray(ids, "<i4")
                ends = np.cumsum(self.size[flat])
                stops = marked[i + 1:j + 1] - marked[i]
                cuts = np.searchsorted(ends, stops)
                if len(ends) and ends[-1] == stops[-1] and (ends[cuts] == stops).all():
                    out.append(flat)
                    counts.append(np.diff(cuts, prepend=-1))
                else:
                    each = self._alone(data, places[i:j + 1].tolist())
                    out += each
                    counts.append([len(x) for x in each])
        return np.concatenate(out), np.concatenate(counts).astype(np.int64)

    def learn(self, parts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all parts one after the other, how many each has, and whether decoding gives the part back."""
        buf, places = text_bytes(parts)
        if not len(parts):
            return np.zeros(0, "<i4"), np.zeros(0, np.int64), np.zeros(0, bool)
        data = buf.tobytes()
        if self.joined:
            flat, count = self._groups(data, places)
        else:
            each = self._alone(data, places.tolist())
            flat, count = np.concatenate(each), np.array([len(x) for x in each], np.int64)
        first = self.surface_at[flat]
        length = self.surface_at[flat + 1] - first
        back = self.surface[ranges(first, first + length)[0]]
        stop = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(count)))]
        if np.array_equal(stop, places) and MARK.encode() not in data:
            wrong = np.concatenate(([0], np.cumsum(back != buf)))
            return flat, count, wrong[places[1:]] == wrong[places[:-1]]
        back, mark = back.tobytes(), MARK.encode()
        return flat, count, np.array([back[a:b] == data[i:j].replace(mark, b" ") for a, b, i, j in zip(
            stop[:-1].tolist(), stop[1:].tolist(), places[:-1].tolist(), places[1:].tolist())], bool)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the first id of each, and whether decoding gives the text as the model sees it."""
        buf, edges, first = self.cut(column)
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf))]
        ).dictionary_encode()
        flat, size, restored = self.learn(coded.dictionary)
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        stop = np.cumsum(size)
        take, _ = ranges((stop - size)[index], stop[index])
        total = np.concatenate(([0], np.cumsum(size[index])))[first]
        bad = np.concatenate(([0], np.cumsum(~restored[index])))[first]
        return flat[take], total, np.diff(bad) == 0


def _encoded(parts: Parts, check, rows: pa.RecordBatch) -> pa.RecordBatch:
    """Ids of whole texts, held against the library's ids of the raw texts."""
    texts = rows.column("text")
    ids, first, restored = parts.encode(texts)
    theirs = check.encode([t or "" for t in texts.to_pylist()], num_threads=1)
    sizes = np.array([len(x) for x in theirs], np.int64)
    flat = np.fromiter(chain.from_iterable(theirs), np.int32, int(sizes.sum()))
    same = np.diff(first) == sizes
    if same.all():
        wrong = np.concatenate(([0], np.cumsum(ids != flat)))[first]
        same = np.diff(wrong) == 0
    else:
        stop = np.cumsum(sizes)
        same = np.array([ok and np.array_equal(ids[first[k]:first[k + 1]], flat[stop[k] - sizes[k]:stop[k]])
                         for k, ok in enumerate(same.tolist())], bool)
    data = ids.tobytes()
    crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)),
         pa.array(same, pa.bool_()), pa.array(restored, pa.bool_()), pa.array(crc, pa.int64())],
        ["doc_id", "ids", "parity", "restored", "ids_crc32"])


def encode_texts(docs: DataFrame, model: bytes, size: int = 1 << 20) -> DataFrame:
    """(doc_id, ids, parity, restored, ids_crc32) of every text.

    ``parity``: the sentencepiece library gives the same ids to the whole raw text; ``restored``:
    decoding gives the normalised text. ``model`` is the model file's content.
    """
    threads = int(docs.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encode(model, threads, size),
        "doc_id long, ids array<int>, parity boolean, restored boolean, ids_crc32 long")


def decode_ids(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    def run(batches):
        encoder = Encoder(parse_model(model))
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """Number and hash of the ids of every text, parity and round trip.

    Larger blocks have fewer distinct parts; behind other stages, whose memory the workers still hold, they would be too large.
    """
    return encode_texts(docs, read_model(path), size=2 << 20).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32", "parity", "restored")
