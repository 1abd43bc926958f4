"""Token ids and counts with public tokenizer files, and a compressed file of ids."""

from __future__ import annotations

import hashlib
import json
import os
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from orderloom.llm.common import least_hashed, whole_text

PIECE = 1 << 18  # characters that are taken apart at a time
GROUP = 1 << 22  # bytes of texts whose distinct words are looked up together
KEPT = 300_000  # distinct pre-tokens whose counts a task remembers
KEPT_IDS = 800_000  # distinct words whose ids a worker process remembers

# The pattern that parts a text before byte-level merges.
PRE_TOKENS = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

# Code points on which the pattern above and the library agree in every class; a test
# checks them all.  Texts with others are counted by the library alone.
AGREED = r"\x00-՗‐-‧‰-⁞€、-㏿一-龥가-힣"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    """The library's tokenizer without padding and truncation, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


# ---------------------------------------------------------------- counts


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    extra = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + k): b for k, b in enumerate(extra)}


def whole_tokens(path: str) -> set[str]:
    """Vocabulary strings that the pattern leaves whole and that alone are one token.

    Proved by running each through pattern and library.  A pre-token's ids do not depend
    on its neighbours, so such a string counts one wherever it is a pre-token.
    """
    found = load_tokenizer(path)
    letters, pattern = _byte_letters(), regex.compile(PRE_TOKENS)
    agreed = regex.compile(f"[{AGREED}]+")
    added = {t.content for t in found.get_added_tokens_decoder().values()}
    texts = []
    for written in found.get_vocab(with_added_tokens=False):
        if written in added or not all(c in letters for c in written):
            continue
        try:
            text = bytes(letters[c] for c in written).decode()
        except UnicodeDecodeError:
            continue
        if agreed.fullmatch(text) and pattern.findall(text) == [text]:
            texts.append(text)
    encoded = found.encode_batch_fast(texts, add_special_tokens=False)
    return {text for text, one in zip(texts, encoded) if len(one) == 1}


def _is_plain_byte_level(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    parts = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and parts.get("type") == "ByteLevel"
        and parts.get("use_regex", True)
        and not parts.get("add_prefix_space")
        and not any(
            t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
            for t in spec.get("added_tokens", [])
        )
    )


class PreTokenCounter:
    """Counts tokens; pre-tokens that are whole tokens are looked up, the others merged."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.library = load_tokenizer(path)
        self.whole = whole
        self.cost = dict.fromkeys(whole, 1)
        self.pattern = regex.compile(PRE_TOKENS)
        self.strange = regex.compile(f"[^{AGREED}]")
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        added.sort(key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def count(self, text: str) -> int:
        if self.strange.search(text):
            return len(self.library.encode(text, add_special_tokens=False))
        if self.added is None:
            return self._plain(text)
        total, at = 0, 0
        for match in self.added.finditer(text):
            total += 1 + self._plain(text[at : match.start()])
            at = match.end()
        return total + self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> int:
        if len(text) <= PIECE:
            return self._pre_tokens(self.pattern.findall(text))
        total, some = 0, []
        for match in self.pattern.finditer(text):
            some.append(match.group())
            if len(some) == PIECE:
                total += self._pre_tokens(some)
                some = []
        return total + self._pre_tokens(some)

    def _pre_tokens(self, found: list[str]) -> int:
        cost = self.cost
        try:
            return sum(map(cost.__getitem__, found))
        except KeyError:
            pass
        if len(cost) > KEPT + len(self.whole):
            cost.clear()
            cost.update(dict.fromkeys(self.whole, 1))
        rest = list({f for f in found if f not in cost})
        for one, ids in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
            cost[one] = len(ids)
        return sum(map(cost.__getitem__, found))


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each document, for a byte-level file.

    Counts are those of the library without special tokens around the text; strings of
    added tokens inside a text count as one.  Null texts are empty: 0 bytes, 0 tokens.
    Repeated rows are counted one by one; a null id stays null; other columns are not
    read; empty tables give no rows.  The set of whole tokens is found once, on the
    driver; it is bounded by the vocabulary, and goes out with the task.
    """
    if not _is_plain_byte_level(path):
        raise ValueError(f"{path} is not a byte-level file with the usual pattern")
    whole = frozenset(whole_tokens(path))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PreTokenCounter(path, whole)
        for batch in batches:
            counts = [counter.count(text.as_py()) for text in batch["text"]]
            sizes = batch["n_bytes"]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    sizes,
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    own = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    sized = own.withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return sized.mapInArrow(
        scan, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )


# ---------------------------------------------------------------- ids


def kept_encoder(path: str) -> WordEncoder:
    """The encoder of this worker process, which Spark uses for one task after another.

    Tasks get their code by value, so it is kept in a module of its own.
    """
    store = sys.modules.setdefault("_orderloom_kept", types.ModuleType("_orderloom_kept"))
    if path not in store.__dict__:
        store.__dict__[path] = WordEncoder(path)
    return store.__dict__[path]


class WordEncoder:
    """Ids of texts for vocabularies that never merge across white space.

    A text's ids are those of its words between white space, one after another, so each
    distinct word is encoded by the library once and then looked up, once for all its
    occurrences in a group of texts.  Texts with the four separators U+001C to U+001F, on
    which Arrow's white space and the library's differ, are encoded whole.
    """

    odd = "[\x1c-\x1f]"
    # on other code points the library's lower case may differ from Python's
    foldable = regex.compile("[\x00-\u012f\u0131-\u024f]+")

    def __init__(self, path: str):
        self.library = load_tokenizer(path)
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for text, i in vocabulary.items() if text.endswith("</w>")]] = True
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self._start()

    def _start(self) -> None:
        self.index: dict[str, int] = {}
        self.entries = 0
        self.flat = np.empty(1 << 16, np.int32)
        self.start = np.empty(1 << 14, np.int64)
        self.length = np.empty(1 << 14, np.int64)
        self.met = np.zeros(1 << 14, np.int32)  # groups of texts in which an entry was met
        self.used = 0
        self._add([",", "."], *self._plain([",", "."]))
        self._add([""], np.empty(0, np.int32), np.zeros(1, np.int64))  # beside outer white space

    def _forget(self) -> None:
        """Drop words met in one group of texts only, and rarer ones until half is free."""
        words = list(self.index)
        entries = np.fromiter(self.index.values(), np.int64, len(words))
        met, least = self.met[entries], 2
        while np.count_nonzero(met >= least) > KEPT_IDS // 2:
            least *= 2
        kept = np.flatnonzero(met >= least)
        ids, lengths = self._gather(entries[kept])
        self._start()
        self._add([words[i] for i in kept.tolist()], ids, lengths)

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        at, total = self.entries, len(ids)
        while len(self.start) < at + len(words):
            self.start = np.concatenate([self.start, self.start])
            self.length = np.concatenate([self.length, self.length])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, self.flat])
        self.flat[self.used : self.used + total] = ids
        self.length[at : at + len(words)] = lengths
        self.start[at : at + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.used += total
        self.entries += len(words)
        self.index.update(zip(words, range(at, at + len(words))))

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.array([i for ids in encoded for i in ids], np.int32), lengths

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, encoded as one text: a token that ends a word says so."""
        whole = self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(whole.ids, np.int32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # the library parts a word that Python calls letters
            return self._plain(words)
        return ids, np.diff(ends, prepend=0)

    def _letters_alone(self, word: str) -> bool:
        """Whether the library's form of the word is letters too.  Some letters end in a
        mark there, which the library joins with a sign behind it."""
        if not word.isalpha():
            return False
        return bool(self.foldable.fullmatch(word)) or (
            unicodedata.normalize("NFC", word).lower().isalpha()
        )

    def _learn(self, words: list[str]) -> None:
        """Ids of new words.  Words in another case, or with a comma or a full stop behind
        letters, follow from the same word without, which alone is encoded."""
        index, folded, marked, fresh = self.index, [], [], set()
        for word in words:
            stem = word.lower()
            # the library looks for added tokens before it folds
            if stem != word and not (
                self.foldable.fullmatch(word) and not (self.added and self.added.search(stem))
            ):
                stem = word
            if stem[-1] in ",." and self._letters_alone(stem[:-1]):
                marked.append((word, stem[:-1], stem[-1]))
                stem = stem[:-1]
            elif stem != word:
                folded.append((word, stem))
            if stem not in index:
                fresh.add(stem)
        letters = [w for w in fresh if w.isalpha()]
        for at in range(0, len(letters), 2000):
            some = letters[at : at + 2000]
            self._add(some, *self._letters(some))
        others = [w for w in fresh if not w.isalpha()]
        if others:
            self._add(others, *self._plain(others))
        for word, stem in folded:
            index[word] = index[stem]
        if marked:
            own = np.fromiter((index[m[1]] for m in marked), np.int64, len(marked))
            sign = np.fromiter((index[m[2]] for m in marked), np.int64, len(marked))
            both = np.column_stack([own, sign]).ravel()
            ids, lengths = self._gather(both)
            self._add([m[0] for m in marked], ids, lengths[0::2] + lengths[1::2])

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self.start[at] - (ends - lengths), lengths)
        return self.flat[places], lengths

    def _look_up(self, words: list[str]) -> np.ndarray:
        """Entries of distinct words."""
        if len(self.index) > KEPT_IDS:
            self._forget()
        index = self.index
        unknown = [word for word in words if word not in index]
        if unknown:
            self._learn(unknown)
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def _group(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; the distinct words of all of them are looked up once."""
        words = pc.utf8_split_whitespace(texts)
        found = words.flatten().dictionary_encode()
        entries = self._look_up(found.dictionary.to_pylist())
        self.met[entries] += 1
        ids, lengths = self._gather(entries[found.indices.to_numpy()])
        places = words.offsets.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths)])[places - places[0]]
        return [ids[at:to] for at, to in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(column):
            return
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        odd = pc.match_substring_regex(column, self.odd).to_numpy(zero_copy_only=False)
        alone = odd | (sizes > PIECE)
        group = np.cumsum(sizes) // GROUP
        first = np.ones(len(column), bool)
        first[1:] = alone[1:] | alone[:-1] | (group[1:] != group[:-1])
        starts = np.flatnonzero(first)
        for at, to in zip(starts.tolist(), np.append(starts[1:], len(column)).tolist()):
            if odd[at]:
                whole = self.library.encode(column[at].as_py(), add_special_tokens=False).ids
                yield np.array(whole, np.uint32)
            elif alone[at]:
                yield self._long(column[at].as_py())
            else:
                yield from self._group(column[at:to])

    def _long(self, text: str) -> np.ndarray:
        parts, at = [], 0
        space = regex.compile(r"\s")
        while at < len(text):
            match = space.search(text, min(at + PIECE, len(text)))
            to = match.end() if match else len(text)
            parts += self._group(pa.array([text[at:to]], pa.string()))
            at = to
        return np.concatenate(parts)


def _joins_no_words(path: str) -> bool:
    """Whether the file drops white space before it merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return bool(parts) and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True


SAMPLE_DOCS = 1000  # of which the dictionary is trained
SAMPLE_BYTES = 16_384  # a sampled document is no longer
CHUNK_BYTES = 1 << 20  # ids, before compression, after which a chunk of the file ends


def _train(docs: DataFrame, path: str, end_id: int, dtype: str, dictionary_bytes: int) -> bytes:
    """A dictionary trained in one task on a bounded sample, empty if there is too little.

    The sample are the SAMPLE_DOCS documents with the least hash among those of 1 to
    SAMPLE_BYTES bytes.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, samples = WordEncoder(path), []
        for batch in batches:
            for ids in encoder.encode(batch["text"]):
                samples.append(np.append(ids, end_id).astype(dtype).tobytes())
        trained = b""
        if len(samples) >= 16 and sum(map(len, samples)) >= 8 * 1024:
            try:
                trained = zstandard.train_dictionary(dictionary_bytes, samples).as_bytes()
            except zstandard.ZstdError:  # the sample is too uniform or too small
                trained = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained], pa.binary())})

    short = docs.where(F.octet_length("text").between(1, SAMPLE_BYTES)).select("doc_id", "text")
    hashed = F.xxhash64("doc_id", "text")
    sample = least_hashed(short, hashed, SAMPLE_DOCS, short.count()).select("text")
    found = sample.coalesce(1).mapInArrow(train, "dictionary binary").collect()
    return bytes(max((r["dictionary"] for r in found), key=len, default=b""))


def write_token_files(
    docs: DataFrame,
    out: str,
    path: str,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    level: int = 3,
    dictionary_bytes: int = 32_768,
) -> None:
    """Encode all documents and write them as files of separately compressed documents.

    ``out``/dictionary holds the shared dictionary and its SHA-256, ``out``/chunks rows
    of about a megabyte of ids: part and number, the dictionary's hash, the ids of the
    documents, how many token ids each has, their offsets in the payload, and the
    payload itself, one zstandard frame per document.  Ids are 16 bits wide where the
    vocabulary allows, else 32, little endian.  Documents are in ascending order of id;
    null ids come first, and equal ids are ordered by hash of text and place in the
    table.  Ids of any integer type are kept as long, others as text.  One document is fetched from its chunk without touching its neighbours.

    Null texts are empty and give only the end id.  The one shuffle sorts the texts, by
    ranges; files are committed by Spark's writer, so lost executors leave no halves.
    """
    if not _joins_no_words(path):
        raise ValueError(f"{path} merges across white space")
    size = load_tokenizer(path).get_vocab_size()
    dtype = "<u2" if max(size, end_id + 1) <= 65536 else "<u4"
    own = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    dictionary = _train(own, path, end_id, dtype, dictionary_bytes)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark = docs.sparkSession
    spark.createDataFrame(
        [(digest, bytearray(dictionary), dtype)], "dict_hash string, dictionary binary, dtype string"
    ).coalesce(1).write.parquet(f"{out}/dictionary")
    whole = isinstance(own.schema["doc_id"].dataType, IntegralType)
    key_type = pa.int64() if whole else pa.string()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = kept_encoder(path)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared)
        number, size = 0, 0
        keys: list = []
        counts: list[int] = []
        frames: list[bytes] = []

        def chunk() -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([digest]),
                    pa.array([sum(counts)], pa.int64()),
                    pa.array([keys], pa.list_(key_type)),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([ends.tolist()], pa.list_(pa.int64())),
                    pa.array([b"".join(frames)], pa.binary()),
                ],
                names=["part", "chunk", "dict_hash", "n_tokens", "doc_ids", "counts",
                       "offsets", "payload"],
            )

        for batch in batches:
            encoded = encoder.encode(batch["text"])
            for one, ids in zip(batch["doc_id"].to_pylist(), encoded):
                raw = np.append(ids, end_id).astype(dtype).tobytes()
                keys.append(one)
                counts.append(len(ids) + 1)
                frames.append(packer.compress(raw))
                size += len(raw)
                if size >= CHUNK_BYTES:
                    yield chunk()
                    number, size, keys, counts, frames = number + 1, 0, [], [], []
        if keys:
            yield chunk()

    kept_type = "long" if key_type == pa.int64() else "string"
    ordered = own.withColumn("doc_id", F.col("doc_id").cast(kept_type)).orderBy(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()
    )
    ordered.mapInArrow(
        write,
        f"part int, chunk int, dict_hash string, n_tokens long, doc_ids array<{kept_type}>, "
        "counts array<long>, offsets array<long>, payload binary",
    ).write.parquet(f"{out}/chunks")


def _dictionary(spark: SparkSession, out: str) -> tuple[str, bytes, str]:
    row = spark.read.parquet(f"{out}/dictionary").first()
    stored = bytes(row["dictionary"])
    if hashlib.sha256(stored).hexdigest() != row["dict_hash"]:
        raise ValueError(f"the dictionary in {out} does not match its hash")
    return row["dict_hash"], stored, row["dtype"]


def _unpacker(digest: str, dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    unpack = zstandard.ZstdDecompressor(dict_data=shared)

    def documents(batch: pa.RecordBatch) -> Iterator[tuple]:
        """(row of the batch, place in the chunk, id, bytes of the ids)."""
        for row in range(batch.num_rows):
            if batch["dict_hash"][row].as_py() != digest:
                raise ValueError("a chunk was written with another dictionary")
            payload = memoryview(batch["payload"][row].as_buffer())
            offsets = batch["offsets"][row].as_py()
            for place, one in enumerate(batch["doc_ids"][row].as_py()):
                yield row, place, one, unpack.decompress(payload[offsets[place] : offsets[place + 1]])

    return documents


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """doc_id and its token ids, from the files."""
    digest, dictionary, dtype = _dictionary(spark, out)
    chunks = spark.read.parquet(f"{out}/chunks")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = _unpacker(digest, dictionary)
        for batch in batches:
            for row in range(batch.num_rows):
                found = list(documents(batch.slice(row, 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f[2] for f in found], batch.schema.field("doc_ids").type.value_type),
                        pa.array(
                            [np.frombuffer(f[3], dtype).astype(np.int32) for f in found],
                            pa.list_(pa.int32()),
                        ),
                    ],
                    names=["doc_id", "ids"],
                )

    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    wanted = chunks.select("dict_hash", "doc_ids", "offsets", "payload")
    return wanted.mapInArrow(scan, f"doc_id {kind}, ids array<int>")


def token_digests(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read back from the files.

    ``start`` counts the ids of all documents before it: inside the chunk while reading,
    then the chunks before it in its part, then the parts before it.
    """
    digest, dictionary, dtype = _dictionary(spark, out)
    chunks = spark.read.parquet(f"{out}/chunks")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = _unpacker(digest, dictionary)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                keys, counts, sums = [], [], []
                for _, _, key, raw in documents(one):
                    ids = np.frombuffer(raw, dtype)
                    keys.append(key)
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                n = len(keys)
                ends = np.cumsum(np.array(counts, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(one["part"].to_numpy(), n)),
                        pa.array(np.repeat(one["chunk"].to_numpy(), n)),
                        pa.array(keys, one.schema.field("doc_ids").type.value_type),
                        pa.array(ends - counts),
                        pa.array(counts, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "chunk", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    read = chunks.select("part", "chunk", "dict_hash", "doc_ids", "offsets", "payload").mapInArrow(
        scan,
        f"part int, chunk int, doc_id {kind}, inside long, n_tokens long, ids_crc32 long",
    )
    sizes = chunks.select("part", "chunk", "n_tokens")
    in_part = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # one row per part
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("parts"))
    starts = sizes.join(offsets, "part").select(
        "part",
        "chunk",
        (F.col("parts") + F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))).alias("first"),
    )
    return read.join(starts, ["part", "chunk"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
