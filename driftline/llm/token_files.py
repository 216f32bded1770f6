"""Token ids in Arrow files: equal-length sequences in fixed-size lists, read back without copying.

Every shard is two Arrow files. ``shard-N.arrow`` holds record batches of two columns: ``ids``, a fixed-size list of unsigned
integers (16 bits if the vocabulary fits, else 32), and ``mask``, a fixed-size list of booleans that is false on padding. Sequence k of a
shard lies at a computable place, so a mapped file gives it without copying. ``shard-N.docs.arrow`` says where in the
shard each document starts and how many ids it has. Shards hold ascending ranges of doc_id; the last sequence of a shard is padded.
"""

from __future__ import annotations

import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions.sizing import shared_dir, store
from driftline.llm.registry import only, query, small_batches, table, tidy

SEQUENCE = 2048
END_ID = 2
BATCH_SEQUENCES = 256
KNOWN_WORDS = 300_000           # words that a worker keeps with their ids, first come
LONG_WORD = 64                  # longer words are encoded but not kept
ENCODE_BYTES = 2 << 20          # text encoded at a time
BLANKS = re.compile(r"\s ")
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
ODD = re.compile(r"[^\t-\r -~¡-©«¬®-±´¶-¸»¿-ɏ‐-‧‰-⁞€]")
# Fixed: how byte-level vocabularies part a text into words, for the letters that are not odd.
WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[0-9]+| ?[^\t-\r {LETTER}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Ids of words as bytes; a word not met before goes to the tokenizer's model."""

    def __init__(self, model, dtype: np.dtype):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, byte_letters()
        self.ids = [np.array(i, dtype).tobytes() for i in range(np.iinfo(dtype).max + 1 if dtype.itemsize == 2 else 0)]
        self.dtype = dtype

    def __missing__(self, word: str) -> bytes:
        tokens = self.tokenize(word.encode().decode("latin-1").translate(self.letters))
        got = b"".join([self.ids[t.id] for t in tokens]) if self.ids else np.array([t.id for t in tokens], self.dtype).tobytes()
        if len(self) < KNOWN_WORDS and len(word) <= LONG_WORD:
            self[word] = got
        return got


class Encoder:
    """Ids of whole texts from a byte-level tokenizer, each distinct word encoded once.

    Such a tokenizer parts a text into words by a fixed pattern and encodes each by itself. Where a text has Latin letters and common marks
    only, words are found here and looked up. Of other texts, only the parts between blanks that hold other letters go to the tokenizer
    itself, since it never joins a blank to what stands before it; a text with such letters and a blank beside other white space goes there whole, as does one that holds
    a special token. The tests compare with whole encoding.
    """

    def __init__(self, path: str, dtype: str):
        self.encode, self.dtype = tokenizer(path), np.dtype(dtype)
        self.words = Words(self.encode.model, self.dtype)
        self.special = [t.content for t in self.encode.get_added_tokens_decoder().values()]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.dtype).tobytes() for e in self.encode.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """An array of ids for each text, without an end id. Null and empty texts have none."""
        get = self.words.__getitem__
        out: list = []
        held: list[str] = []                # for the tokenizer itself; in ``out``, numbers stand for them
        for text in texts:
            if not text:
                out.append([b""])
            elif any(s in text for s in self.special):
                out.append([len(held)])
                held.append(text)
            elif not ODD.search(text):
                out.append([b"".join(map(get, WORDS.findall(text)))])
            elif "\0" in text or text[0] == " " or text[-1] == " " or BLANKS.search(text):
                out.append([len(held)])
                held.append(text)
            else:
                own: list = []
                for part in text.replace(" ", "\0 ").split("\0"):
                    if ODD.search(part):
                        own.append(len(held))
                        held.append(part)
                    else:
                        own += map(get, WORDS.findall(part))
                out.append(own)
        if held:
            whole = self._whole(held)
            out = [[whole[x] if isinstance(x, int) else x for x in own] for own in out]
        return [np.frombuffer(own[0] if len(own) == 1 else b"".join(own), self.dtype) for own in out]


def encoder(path: str, dtype: str) -> Encoder:
    return only(("encoder", path, dtype), lambda: Encoder(path, dtype))


def files(folder: str):
    """The file system of a shared folder and its path there; any that pyarrow can open."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class ShardWriter:
    """Writes one shard; sequences leave for the file as they fill, so memory stays bounded."""

    def __init__(self, folder: str, shard: int, length: int, dtype, per_batch: int = BATCH_SEQUENCES):
        self.store, base = files(folder)
        self.length, self.dtype, self.per_batch = length, np.dtype(dtype), per_batch
        # A retried or doubled task writes its own files and moves them into place when they are whole.
        self.final = [f"{base}/shard-{shard:06d}.arrow", f"{base}/shard-{shard:06d}.docs.arrow"]
        self.temp = [f"{p}.{uuid.uuid4().hex}" for p in self.final]
        value = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(pa.field("item", value, False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))],
                                metadata={"sequences_per_batch": str(per_batch)})
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.store.open_output_stream(p) for p in self.temp]
        self.ids = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], self.docs_schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.written = self.n_docs = 0

    def add(self, doc_ids: list, encoded: list[np.ndarray]) -> None:
        sizes = np.array([len(e) for e in encoded], np.int64)
        first = self.written + self.n_held + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(first), pa.array(sizes)], schema=self.docs_schema))
        self.n_docs += len(doc_ids)
        for e in encoded:
            self.held.append(e)
            self.n_held += len(e)
            if self.n_held >= self.length * self.per_batch:
                self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.dtype)
        whole = len(flat) - len(flat) % (self.length * self.per_batch)      # only full batches but for the last
        n = len(flat) if last else whole
        rows, real = -(-n // self.length), n
        body = flat[:n]
        if rows * self.length > n:
            body = np.concatenate([body, np.zeros(rows * self.length - n, self.dtype)])
        for at in range(0, rows, self.per_batch):
            part = body[at * self.length:(at + self.per_batch) * self.length]
            mask = np.arange(at * self.length, at * self.length + len(part)) < real
            self.ids.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(part), type=self.schema.field("ids").type),
                                                  pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field("mask").type)], schema=self.schema))
        self.written += n
        self.held, self.n_held = ([] if n == len(flat) else [flat[n:]]), len(flat) - n

    def close(self) -> None:
        self._flush(True)
        for w, sink, temp, final in zip((self.ids, self.docs), self.sinks, self.temp, self.final):
            w.close()
            sink.close()
            self.store.move(temp, final)


def read_shard(folder: str, shard: int):
    """Yields (doc_id, first id's place in the shard, ids) of each document, reading the files batch by batch."""
    store_, base = files(folder)
    ids = pa.ipc.open_file(store_.open_input_file(f"{base}/shard-{shard:06d}.arrow"))
    docs = pa.ipc.open_file(store_.open_input_file(f"{base}/shard-{shard:06d}.docs.arrow"))
    length = ids.schema.field("ids").type.list_size
    per, now, held = int(ids.schema.metadata[b"sequences_per_batch"]) * length, -1, None

    def pieces(at: int, n: int):
        nonlocal now, held
        while n:
            b, off = divmod(at, per)
            if b != now:        # every batch but the last is full: so a place says which batch
                now, held = b, ids.get_batch(b).column(0).flatten().to_numpy()
            yield (got := held[off:off + n])
            at, n = at + len(got), n - len(got)

    for b in range(docs.num_record_batches):
        for doc_id, first, n in zip(*(c.to_pylist() for c in docs.get_batch(b).columns)):
            yield doc_id, first, pieces(first, n)


def sequence(folder: str, shard: int, k: int):
    """Sequence ``k`` of a shard and its mask, by place: one batch is touched, and none copied if the store maps files."""
    store_, base = files(folder)
    file = pa.ipc.open_file(store_.open_input_file(f"{base}/shard-{shard:06d}.arrow"))
    b, at = divmod(k, int(file.schema.metadata[b"sequences_per_batch"]))
    ids, mask = file.get_batch(b).columns
    length = ids.type.list_size
    at = slice(at * length, (at + 1) * length)
    return ids.flatten().to_numpy()[at], mask.flatten().to_numpy(zero_copy_only=False)[at]


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, length: int = SEQUENCE,
                 per_batch: int = BATCH_SEQUENCES) -> DataFrame:
    """Encode ``docs`` in ascending doc_id order into ``folder``; (shard, n_docs, n_tokens) of the shards written.

    Null ids come first; rows of equal id follow by text, so reruns agree. Null and empty texts are written as the end id alone.
    A special token's string in a text is that token, as the library has it unless told otherwise.
    Other columns are not read. An empty table gives no shards. Runs when this is called.
    """
    spark = docs.sparkSession
    small_batches(spark)
    store_, base = files(folder)
    store_.create_dir(base, recursive=True)
    dtype = "uint16" if tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "uint32"
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def write(batches):
        from pyspark import TaskContext

        shard, out, enc = TaskContext.get().partitionId(), None, encoder(tokenizer_path, dtype)
        n_docs = n_tokens = 0
        end = np.array([end_id], dtype)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in texts])
            at = 0
            while at < len(ids):
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + ENCODE_BYTES, "right")))
                out = out or ShardWriter(folder, shard, length, dtype, per_batch)
                encoded = [np.concatenate([e, end]) for e in enc.batch(texts.slice(at, to - at).to_pylist())]
                out.add(ids[at:to], encoded)
                n_docs, n_tokens, at = n_docs + to - at, n_tokens + sum(map(len, encoded)), to
        if out:
            out.close()
            yield pa.record_batch([pa.array([shard], pa.int64()), pa.array([n_docs], pa.int64()), pa.array([n_tokens], pa.int64())], names=["shard", "n_docs", "n_tokens"])

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*order)
    return store(ordered.mapInArrow(tidy(write), "shard long, n_docs long, n_tokens long"))


def read_documents(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, shard."""
    # One row per shard; each shard's start is the sum before it.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))

    def read(batches):
        for batch in batches:
            for shard, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc_id, first, pieces in read_shard(folder, shard):
                    crc = n = 0
                    for p in pieces:
                        crc, n = zlib.crc32(np.ascontiguousarray(p, "<u4").tobytes(), crc), n + len(p)
                    rows.append((doc_id, base + first, n, crc, shard))
                for at in range(0, len(rows), 20_000):
                    cols = list(zip(*rows[at:at + 20_000]))
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    tasks = starts.select("shard", "base").repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "shard")
    return tasks.mapInArrow(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long, shard long")


def write_and_read(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """``read_documents`` of what ``write_shards`` wrote to ``folder``, by default a new one in the shared folder."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens/{uuid.uuid4().hex}"
    return read_documents(spark, folder, write_shards(docs, folder, tokenizer_path))


@query()
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, size and checksum, read back from the files; null and empty texts are the end id alone, equal rows follow each other."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return write_and_read(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")
