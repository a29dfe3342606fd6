"""Token ids in Arrow stream files of equal-length sequences, and back.

Documents are range-sorted by doc_id; a task encodes its range with the
tokenizers library and lays the ids of all its documents one after the other
into sequences of ``length`` ids. A file is an Arrow stream of record batches
with two fixed-size-list columns, ``ids`` and ``mask`` (false in the padding of
a file's last sequence), so sequence k is found by arithmetic and read without a
copy from a memory map. Its schema metadata hold the documents' ids and lengths.
A file has at most about ``file_ids`` ids, or one document.

The files are written and read by Spark (one binary row per file), hence on any
file system that Spark reaches, with Spark's commit for retried tasks.

Defined results: a null or empty text has only the end id; rows that share a
doc_id, repeated ones too, follow each other in text order; rows without doc_id come first; a text of any length
lies whole in one file; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.arrays import ranges, space_words, text_blocks, word_spans
from tallyworks.operators.ordering import running_total
from tallyworks.session import fresh_path, materialize

# Parts that need no Unicode normalising, in RE2's form.
SIMPLE = "^[!-&(-~À-ÖØ-öø-ÿ]+$"


class WordEncoder:
    """Ids of texts by a word-splitting BPE tokenizer file, each distinct part encoded once.

    Words are what ASCII white space parts; the tokenizer's own patterns never
    join across it. Words of printable ASCII and Latin-1 letters, without an
    apostrophe, need no Unicode normalising: they are lower-cased and cut into runs of
    letters, digits and runs of other signs as bytes, and the library's model gets
    many such parts in one call. Any other word goes to the whole tokenizer.
    """

    def __init__(self, path: str, held: int = 250_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.whole.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.whole.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        self.ends[[i for piece, i in self.whole.get_vocab().items() if piece.endswith("</w>")]] = True
        self.held = held
        self._forget()

    def _forget(self) -> None:
        """No known parts: ``ids`` holds the ids of all parts, ``first`` and ``size`` say where those of each are."""
        self.known = pa.array([], pa.large_string())
        self.ids = np.zeros(0, self.kind)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _joined(self, parts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of simple parts, many in one call, and how many each has; None if the library cuts them otherwise."""
        edges = pa.array([*range(0, len(parts), 500), len(parts)], pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(edges, parts), pa.scalar(" ", parts.type)).to_pylist()
        ids = np.concatenate([np.asarray(e.ids, self.kind)
                              for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)])
        cuts = np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1))
        return (ids, np.diff(cuts)) if len(cuts) == len(parts) + 1 and cuts[-1] == len(ids) else None

    def _learn(self, parts: pa.LargeStringArray) -> None:
        """Add parts that are not known yet, in their order."""
        plain = pc.and_(pc.match_substring_regex(parts, SIMPLE), pc.invert(pc.match_substring(parts, "<|")))
        plain = plain.to_numpy(zero_copy_only=False)
        simple, rest = np.flatnonzero(plain), [np.flatnonzero(~plain)]
        found = [(np.zeros(0, np.int64), self.ids[:0], np.zeros(0, np.int64))]
        for at in range(0, len(simple), 20_000):
            some = simple[at:at + 20_000]
            got = self._joined(parts.take(pa.array(some)))
            if got is None:
                rest.append(some)
            else:
                found.append((some, *got))
        rest = np.concatenate(rest)
        for at in range(0, len(rest), 5000):
            some = rest[at:at + 5000]
            each = [e.ids for e in self.whole.encode_batch_fast(parts.take(pa.array(some)).to_pylist(), add_special_tokens=False)]
            found.append((some, np.array([i for ids in each for i in ids], self.kind), np.array([len(ids) for ids in each])))
        which, ids, sizes = (np.concatenate(x) for x in zip(*found))
        first, size = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        first[which], size[which] = len(self.ids) + np.cumsum(sizes) - sizes, sizes
        self.known = pa.concat_arrays([self.known, parts])
        self.ids = np.concatenate([self.ids, ids])
        self.first, self.size = np.append(self.first, first), np.append(self.size, size)

    def encode(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id``, and how many each has."""
        buf, starts, ends, first = _parts(buf, offs)
        places = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        # parts fill the words without a gap, so their bytes are all but the white space
        parts = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(places), pa.py_buffer(buf[space_words()[buf]])).dictionary_encode()
        if len(self.known) > self.held:
            self._forget()
        found = pc.index_in(parts.dictionary, value_set=self.known)
        new = found.is_null()
        at = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[new.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(found.null_count)
        if found.null_count:
            self._learn(parts.dictionary.filter(new))
        # the end of a text is one part more
        flat = np.append(self.ids, np.asarray([end_id], self.kind))
        begin, size = np.append(self.first[at], len(self.ids)), np.append(self.size[at], 1)
        order = np.insert(parts.indices.to_numpy(zero_copy_only=False).astype(np.int64), first[1:], len(at))
        total = np.concatenate(([0], np.cumsum(size[order])))
        take, _ = ranges(begin[order], (begin + size)[order])
        return flat[take], np.diff(total[first + np.arange(len(first))])


def _parts(buf: np.ndarray, offs: np.ndarray):
    """Bytes with simple words in lower case, start and end of each part (a run of letters, a
    digit, a run of other signs, or a whole word that is not simple), first part of each text."""
    starts, ends, _ = word_spans(buf, offs, space_words())
    n = len(buf)
    if not len(starts):
        return buf, starts, ends, np.zeros(len(offs), np.int64)
    lead, after = buf == 0xC3, np.zeros(n, bool)
    after[1:] = lead[:-1]
    # the second byte of a Latin-1 letter; 0x97 and 0xB7 are no letters
    letter2 = after & (buf >= 0x80) & (buf <= 0xBF) & (buf != 0x97) & (buf != 0xB7)
    good2 = np.zeros(n, bool)
    good2[:-1] = letter2[1:]
    letter = ((buf | 0x20) >= 0x61) & ((buf | 0x20) <= 0x7A) & (buf < 0x80) | letter2 | (lead & good2)
    digit = (buf >= 0x30) & (buf <= 0x39)
    other = (buf > 0x20) & (buf < 0x7F) & ~letter & ~digit & (buf != 0x27)
    hard_bytes = np.concatenate(([0], np.cumsum(~(letter | digit | other))))
    hard = hard_bytes[ends] > hard_bytes[starts]
    # the library's special strings start with <|
    mark = np.zeros(n + 1, np.int64)
    mark[1:n] = np.cumsum((buf[:-1] == 0x3C) & (buf[1:] == 0x7C))
    mark[n] = mark[n - 1] if n else 0
    hard |= mark[np.maximum(ends - 1, starts)] > mark[starts]
    kind = np.where(letter, 1, np.where(digit, 2, 3)).astype(np.int8)
    begin = np.zeros(n, bool)
    begin[starts] = True
    inside = space_words()[buf]
    inside &= ~hard[np.maximum(np.cumsum(begin) - 1, 0)]
    begin[:] = False
    begin[1:] = inside[1:] & ((kind[1:] != kind[:-1]) | digit[1:])
    begin[starts] = True
    low = buf.copy()
    upper = inside & (((buf >= 0x41) & (buf <= 0x5A)) | (letter2 & (buf >= 0x80) & (buf <= 0x9E)))
    low[upper] += 0x20
    part_start = np.flatnonzero(begin)
    word = np.searchsorted(starts, part_start, "right") - 1
    part_end = np.minimum(np.append(part_start[1:], n), ends[word])
    return low, part_start, part_end, np.searchsorted(part_start, offs)


def _stream(ids: np.ndarray, docs: list, sizes: list, length: int, part: int, number: int) -> bytes:
    """One file: ids in rows of ``length``, the last one padded."""
    rows = max(1, -(-len(ids) // length))
    full = np.zeros(rows * length, ids.dtype)
    full[:len(ids)] = ids
    mask = np.arange(rows * length) < len(ids)
    none = [d is None for d in docs]
    meta = {"docs": np.array([d or 0 for d in docs], "<i8").tobytes(), "null_docs": np.array(none, "?").tobytes(),
            "sizes": np.array(sizes, "<i8").tobytes(), "place": f"{part},{number}"}
    kind = pa.from_numpy_dtype(ids.dtype)
    schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))], metadata=meta)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema) as writer:
        for at in range(0, rows, 256):
            cut = slice(at * length, min(rows, at + 256) * length)
            writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(full[cut]), length),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask[cut]), length)], schema=schema))
    return out.getvalue().to_pybytes()


def _files(path: str, end_id: int, length: int, file_ids: int, threads: int):
    def run(batches):
        # as many threads as the task has cores; more would only hold more memory
        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        encoder, part, number = WordEncoder(path), TaskContext.get().partitionId(), 0
        ids, docs, sizes, held = [], [], [], 0
        for rows, buf, offs in text_blocks(batches, size=1 << 21):
            got, count = encoder.encode(buf, offs, end_id)
            ids.append(got)
            docs += rows.column("doc_id").to_pylist()
            sizes += count.tolist()
            held += len(got)
            if held >= file_ids:
                yield pa.RecordBatch.from_pydict({"file": pa.array(
                    [_stream(np.concatenate(ids), docs, sizes, length, part, number)], pa.binary())})
                ids, docs, sizes, held, number = [], [], [], 0, number + 1
                pa.default_memory_pool().release_unused()
        if docs:
            yield pa.RecordBatch.from_pydict({"file": pa.array(
                [_stream(np.concatenate(ids), docs, sizes, length, part, number)], pa.binary())})
    return run


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, length: int = 2048,
                      file_ids: int = 2 << 20, range_bytes: int = 32 << 20) -> None:
    """Write the ids of all texts, in ascending doc_id order, as Arrow stream files under ``path``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = texts.repartitionByRange(max(1, -(-size // range_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")
    threads = int(docs.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))
    files = ordered.mapInArrow(_files(tokenizer, end_id, length, file_ids, threads), "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def open_stream(content) -> tuple[pa.Schema, list[pa.RecordBatch]]:
    """Schema and batches of a file, without a copy; ``content``: bytes or a memory map."""
    reader = pa.ipc.open_stream(content)
    return reader.schema, list(reader)


def sequence(batches: list[pa.RecordBatch], k: int) -> tuple[np.ndarray, pa.Array]:
    """Ids and mask of sequence ``k``, views into the file."""
    ahead = batches[0].num_rows
    ids, mask = (batches[k // ahead].column(c) for c in ("ids", "mask"))
    length, at = ids.type.list_size, k % ahead
    return ids.values.to_numpy(zero_copy_only=True)[at * length:(at + 1) * length], mask.values.slice(at * length, length)


def _documents(batches):
    for batch in batches:
        for content in batch.column("content"):
            schema, parts = open_stream(content.as_buffer())
            meta = schema.metadata
            ids = np.concatenate([p.column("ids").values.to_numpy() for p in parts])
            mask = np.concatenate([p.column("mask").values.to_numpy(zero_copy_only=False) for p in parts])
            flat = ids[mask].astype("<u4")
            sizes = np.frombuffer(meta[b"sizes"], "<i8")
            stops = np.cumsum(sizes)
            docs = pa.array(np.frombuffer(meta[b"docs"], "<i8"), mask=np.frombuffer(meta[b"null_docs"], "?"))
            part, number = (int(x) for x in meta[b"place"].split(b","))
            crc = [zlib.crc32(flat[a:b]) for a, b in zip((stops - sizes).tolist(), stops.tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(np.full(n, part)), pa.array(np.full(n, number)), pa.array(stops - sizes),
                 pa.array(sizes), pa.array(crc, pa.int64())],
                ["doc_id", "part", "number", "at", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    rows = materialize(spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        _documents, "doc_id long, part long, number long, at long, n_tokens long, ids_crc32 long"), "documents")
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    before = running_total(files, ["part", "number"], "n", "before", inclusive=False).drop("n")
    return rows.join(before, ["part", "number"]).select(
        "doc_id", (F.col("before") + F.col("at")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write all documents to fresh token files and read them back."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(docs.sparkSession, path)
