"""Byte-pair encoding of a whole corpus with a public vocabulary.

The words of a batch are laid out in one linked list of symbols. A pair index maps each adjacent
pair to all its positions; the ranks of the pairs that occur are taken in ascending order, each
merge is applied at all its positions and the lists of the affected pairs are updated. As a merge
always comes after those that make its parts (checked when the vocabulary is read), ascending order
over the batch gives each word what merging its lowest rank first would give.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import ship_file, shipped

#: Folder of the public vocabularies; the files stay there.
TOKENIZERS = os.environ.get("GLEANER_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the pattern that splits text into words before the merges.
WORD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters encoded together; words kept from one group to the next (a cache, without effect on results).
GROUP_CHARS, KEPT_WORDS, LONGEST_KEPT = 1 << 20, 200_000, 64


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class PairIndexEncoder:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.byte_ids = [vocab[c] for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        made = dict.fromkeys(self.byte_ids, -1)
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair, new = (vocab[a], vocab[b]), vocab[a + b]
            if not (pair[0] in made and pair[1] in made and max(made[pair[0]], made[pair[1]]) < rank) or new in made:
                raise ValueError(f"merge {rank} does not follow the merges of its parts")
            made[new] = rank
            self.merges[pair] = (rank, new)
        self.pairs = list(self.merges)
        self.split = regex.compile(WORD).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word, by one pair index over all of them."""
        symbols: list[int] = []
        after: list[int] = []
        before: list[int] = []
        starts: list[int] = []
        byte_ids, merges = self.byte_ids, self.merges
        index: dict[tuple[int, int], list[int]] = {}
        for w in words:
            at = len(symbols)
            ids = [byte_ids[b] for b in w.encode("utf-8", "surrogatepass")]
            starts.append(at)
            n = len(ids)
            symbols += ids
            after += range(at + 1, at + n)
            after.append(-1)
            before.append(-1)
            before += range(at, at + n - 1)
            for i in range(n - 1):
                pair = (ids[i], ids[i + 1])
                if pair in merges:
                    index.setdefault(pair, []).append(at + i)
        active = [merges[p][0] for p in index]
        heapify(active)
        pairs = self.pairs
        while active:
            pair = pairs[heappop(active)]
            left, right = pair
            new = merges[pair][1]
            places = index.pop(pair)
            places.sort()
            for i in places:
                j = after[i]
                if symbols[i] != left or j < 0 or symbols[j] != right:
                    continue  # an earlier merge took one of the two
                k = after[j]
                symbols[i], symbols[j], after[i] = new, -1, k
                if k >= 0:
                    before[k] = i
                    fresh = (new, symbols[k])
                    if fresh in merges:
                        if fresh not in index:
                            index[fresh] = []
                            heappush(active, merges[fresh][0])
                        index[fresh].append(i)
                h = before[i]
                if h >= 0:
                    fresh = (symbols[h], new)
                    if fresh in merges:
                        if fresh not in index:
                            index[fresh] = []
                            heappush(active, merges[fresh][0])
                        index[fresh].append(h)
        out = []
        for at in starts:
            ids = []
            i = at
            while i >= 0:
                ids.append(symbols[i])
                i = after[i]
            out.append(tuple(ids))
        return out

    def encode_group(self, texts: Iterable[str]) -> list[list[tuple[int, ...]]]:
        """The ids of the words of each text; each distinct word is encoded once."""
        split = [self.split(t) for t in texts]
        known = self.known
        missing = list({w for ws in split for w in ws if w not in known})
        own = dict(zip(missing, self.encode_words(missing), strict=True))
        result = [[known[w] if w in known else own[w] for w in ws] for ws in split]
        if len(known) > KEPT_WORDS:
            known.clear()
        known.update((w, ids) for w, ids in own.items() if len(w) <= LONGEST_KEPT)
        return result

    def groups(self, texts: list[str | None]) -> Iterator[list[list[tuple[int, ...]]]]:
        """`encode_group` over consecutive texts of about GROUP_CHARS together; null counts as empty."""
        group: list[str] = []
        size = 0
        for t in texts:
            group.append(t or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                yield self.encode_group(group)
                group, size = [], 0
        if group:
            yield self.encode_group(group)


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexEncoder:
    """The encoder of a vocabulary file, read once in each worker: where the file lies, else as the driver gave it."""
    return PairIndexEncoder(shipped(path))


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, folder: str = TOKENIZERS) -> DataFrame:
    """(key, ids ARRAY<INT>) of each row, without special tokens; text like one is ordinary text.

    Null and empty texts give an empty list; a null key keeps its row. Rows are encoded where they
    are read: no shuffle, and only the two columns are scanned.
    """
    path = os.path.join(folder, vocabulary)
    ship_file(df.sparkSession, path)
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            flat, ends = array("i"), array("i", [0])
            for group in bpe.groups(b.column(1).to_pylist()):
                for words in group:
                    for ids in words:
                        flat.extend(ids)
                    ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(memoryview(ends), pa.int32()), pa.array(memoryview(flat), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["key", "ids"])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"key {key_type}, ids array<int>").withColumnRenamed("key", key)


def count_tokens(df: DataFrame, text: str, into: str, vocabulary: str = VOCABULARY, folder: str = TOKENIZERS) -> DataFrame:
    """`df` without `text`, with the BIGINT column `into`: the number of ids of the text, 0 for null and empty ones."""
    path = os.path.join(folder, vocabulary)
    ship_file(df.sparkSession, path)
    rest = [c for c in df.columns if c != text]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            n = array("q")
            for group in bpe.groups(b.column(len(rest)).to_pylist()):
                n.extend(sum(map(len, words)) for words in group)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array(memoryview(n), pa.int64())], [*rest, into])

    return df.select(*rest, text).mapInArrow(run, f"{schema}{', ' if schema else ''}`{into}` bigint")
