"""Token ids and counts of whole texts, with two tiers of known pre-tokens.

A pre-token here is a run of non-white space.  The tokenizer drops white space
and never looks across it, so a text's ids are its pre-tokens' ids in a row, and
each different pre-token has to be encoded only once.

``TextEncoder`` lives in a Python worker.  A slice of texts is split and
dictionary-encoded by Arrow, so per-occurrence work stays in compiled code;
only the slice's different pre-tokens are looked up.  What no tier knows is
split into a run of Latin letters and a run of ASCII punctuation (both are
units of the tokenizer's own splitting), encoded by the library in one call,
and kept in the worker's cache, which is bounded.  Any other pre-token
(digits, other scripts, apostrophes, special strings) is given to the library
whole, and a text with characters that other rules may take as white space is
encoded whole.

``count_tokens`` adds the map-side table: the most frequent pre-tokens of the
corpus with their lengths, found by bounded summaries per task (Misra-Gries
style: only the ``top`` largest counts of a task leave it), at most
``TABLE_ROWS`` entries, so its broadcast has a fixed bound.  Pre-tokens
themselves are never shuffled.

Defined results
  * NULL text counts as empty: no ids, 0 tokens, 0 bytes.
  * Special strings inside texts get the library's default treatment.
  * Long texts are read whole: a text longer than ``SLICE_BYTES`` is a slice of its own.
  * Equally frequent pre-tokens: which of them the table holds changes no count.
  * Repeated rows are separate rows; other columns, whatever their names, are not
    read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of a worker's cache, of a task's summary and of the broadcast table.
CACHE_ROWS = 300_000
SUMMARY_ROWS = 8_192
TABLE_ROWS = 65_536
#: Bytes of text that are handled at once.
SLICE_BYTES = 4 << 20
LIMIT = 2048

#: A run of Latin letters, then a run of ASCII punctuation: two units of the tokenizer's splitting.
_PLAIN = r"^(?P<a>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<b>[!-&(-/:-@\[-`{-~]*)$"
#: Characters on which definitions of white space differ.
_ODD = r"[\x1c-\x1f\x85\x{180e}\x{200b}\x{feff}]"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TextEncoder:
    """Encodes texts with the tokenizers file at ``path``."""

    def __init__(self, path: str, cache_rows: int = CACHE_ROWS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.full = Tokenizer.from_file(path)
        # The same model without normalisation; units are joined by blanks.
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = CharDelimiterSplit(" ")
        known = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
        spare = iter(range(256, 512))
        self.byte_chars = {b: chr(b) if b in known else chr(next(spare)) for b in range(256)}
        del self.byte_chars[32]
        vocabulary = self.full.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.cache_rows = cache_rows

    def _lookup(self, units: list[str]) -> list[bytes]:
        """Ids of different units; two generations of the cache keep what is in use."""
        if len(self.cache) > self.cache_rows // 2:
            self.older, self.cache = self.cache, {"": b""}
        cache, older = self.cache, self.older
        new = []
        for u in [u for u in units if u not in cache]:
            if u in older:
                cache[u] = older[u]
            else:
                new.append(u)
        for i in range(0, len(new), 8192):
            part = new[i:i + 8192]
            joined = " ".join(part).encode().decode("latin-1").translate(self.byte_chars)
            ids = np.array(self.bare.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            stop = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            cache.update(zip(part, (raw[a:b] for a, b in zip([0, *stop], stop))))
        return [cache[u] for u in units]

    def units_of(self, pretokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, lengths, pairs): the units' ids one after another, the number of
        each unit's ids, and for each pre-token its two units (the second may be empty)."""
        both = pc.extract_regex(pretokens, _PLAIN)
        hard = np.flatnonzero(both.is_null().to_numpy(zero_copy_only=False))
        a, b = (pc.fill_null(pc.struct_field(both, i), "") for i in (0, 1))
        coded = pa.concat_arrays([pc.utf8_lower(a), b, pa.array([""])]).dictionary_encode()
        raw = self._lookup(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy(zero_copy_only=False)
        pairs = at[:-1].reshape(2, -1).T.astype(np.int64)
        pairs[hard, 0] = np.arange(len(raw), len(raw) + len(hard))
        texts = pretokens.take(pa.array(hard)).to_pylist()
        raw += [np.array(e.ids, "<u4").tobytes()
                for e in self.full.encode_batch_fast(texts, add_special_tokens=False)]
        return np.frombuffer(b"".join(raw), "<u4"), np.fromiter(map(len, raw), np.int64, len(raw)) // 4, pairs

    def lengths_of(self, pretokens: pa.Array) -> np.ndarray:
        _, lengths, pairs = self.units_of(pretokens)
        return lengths[pairs].sum(axis=1)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4")


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) with about ``size`` bytes each; a longer text is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield start, column.slice(start, stop - start)
        start = stop


def split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Pre-tokens of all texts as one dictionary array, the texts' bounds in it, and which texts are odd."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    lists = pc.utf8_split_whitespace(pc.if_else(pa.array(odd), "", texts) if odd.any() else texts)
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    values = lists.flatten()
    keep = pc.not_equal(values, "")  # white space at the ends leaves empty pieces
    if not pc.all(keep).as_py():
        kept = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False))))
        bounds, values = kept[bounds], values.filter(keep)
    return values.dictionary_encode(), bounds, odd


def encode_texts(encoder: TextEncoder, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text, in order, as unsigned 32-bit numbers."""
    coded, bounds, odd = split(texts)
    flat, lengths, pairs = encoder.units_of(coded.dictionary)
    units = pairs[coded.indices.to_numpy(zero_copy_only=False)].ravel()
    n = lengths[units]
    ends = np.concatenate(([0], np.cumsum(n)))
    first = np.concatenate(([0], np.cumsum(lengths)))
    ids = flat[np.repeat(first[units] - ends[:-1], n) + np.arange(ends[-1])]
    for i in range(len(texts)):
        yield encoder.whole(texts[i].as_py()) if odd[i] else ids[ends[2 * bounds[i]]:ends[2 * bounds[i + 1]]]


def worker_encoder(path: str) -> TextEncoder:
    """The worker's encoder; it outlives a task where Spark reuses workers."""
    import sys

    held = sys.modules.setdefault("recsift_worker_encoders", type(sys)("recsift_worker_encoders")).__dict__
    if path not in held:
        held[path] = TextEncoder(path)
    return held[path]


def frequent_pretokens(docs: DataFrame, summary: int = SUMMARY_ROWS, top: int = TABLE_ROWS) -> list[str]:
    """The ``top`` most frequent pre-tokens over all documents, as far as tasks' bounded summaries tell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = pa.array([], pa.string()), np.zeros(0, np.int64)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                coded, _, _ = split(texts)
                n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
                both = pa.concat_arrays([words, coded.dictionary]).dictionary_encode()
                total = np.zeros(len(both.dictionary), np.int64)
                np.add.at(total, both.indices.to_numpy(zero_copy_only=False), np.concatenate((counts, n)))
                best = np.argsort(-total, kind="stable")[:summary]
                words, counts = both.dictionary.take(pa.array(best)), total[best]
        yield pa.RecordBatch.from_arrays([words, pa.array(counts)], ["word", "n"])

    found = docs.select("text").mapInArrow(run, "word string, n long").where(F.octet_length("word") <= 64)
    rows = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(top)
    return [r[0] for r in rows.select("word").collect()]  # at most top rows of at most 64 bytes


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_tokens, over_limit)."""
    path = path or tokenizer_path()
    words = frequent_pretokens(docs)
    lengths = TextEncoder(path).lengths_of(pa.array(words, pa.string()))
    frequent = docs.sparkSession.sparkContext.broadcast(("\n".join(words), lengths.astype(np.uint8).tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        text, counted = frequent.value
        table = pa.array(text.split("\n"), pa.string())
        known = np.append(np.frombuffer(counted, np.uint8).astype(np.int64), 0)
        for batch in batches:
            tokens, size = [], pc.fill_null(pc.binary_length(batch.column(1)), 0)
            for _, texts in slices(batch.column(1)):
                coded, bounds, odd = split(texts)
                at = pc.fill_null(pc.index_in(coded.dictionary, table), -1).to_numpy(zero_copy_only=False)
                n = known[at] if len(at) else np.zeros(0, np.int64)
                miss = np.flatnonzero(at < 0)
                n[miss] = encoder.lengths_of(coded.dictionary.take(pa.array(miss)))
                sums = np.concatenate(([0], np.cumsum(n[coded.indices.to_numpy(zero_copy_only=False)])))
                each = sums[bounds[1:]] - sums[bounds[:-1]]
                for i in np.flatnonzero(odd):
                    each[i] = len(encoder.whole(texts[int(i)].as_py()))
                tokens.append(each)
            tokens = np.concatenate(tokens).astype(np.int64) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), size.cast(pa.int64()), pa.array(tokens),
                                              pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
