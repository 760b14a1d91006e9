"""All candidate pairs of two sets of records, compared cell by cell and never stored.

Records are packed into chunks of a bounded number, one compressed binary each. A cell is a chunk of
bank records and a chunk of listings: their pairs are made from sorted keys in memory, compared at
once, and of each listing only its best pair and the sum of its odds leave the cell. So no block of
keys is too large to be compared whole, and what goes to disk grows with the records, not with the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa

#: Most records of a chunk (more only if versions of one id outnumber it), and most keys in common that are expanded at once.
CHUNK, AT_ONCE = 131_072, 400_000
#: Letters that fit in one word of the bit-parallel edit distance, and pairs of texts worked on at once.
WORD, TEXTS_AT_ONCE = 64, 20_000
#: Integer columns of a packed record; texts are hashed where they are only compared for equality.
NUMBERS = ("issuer", "value", "spend", "until", "kind", "listed", "merchant")
PACKED = "side string, chunk bigint, n bigint, data binary"


# --- chunks ----------------------------------------------------------------------------------------


def _pieces(t: pa.Table, whole: bool) -> Iterator[tuple[pa.Table, bool]]:
    """The table in pieces of one side and at most CHUNK rows, cut between ids; the last is (rest, False) unless `whole`."""
    side, rid = (t[c].to_numpy(zero_copy_only=False) for c in ("side", "id"))
    turns = np.flatnonzero(side[1:] != side[:-1]) + 1
    starts = np.union1d(turns, np.flatnonzero(rid[1:] != rid[:-1]) + 1)
    at, n = 0, t.num_rows
    while at < n:
        end = min([n, *turns[turns > at][:1]])
        if end - at > CHUNK:
            before = starts[(starts > at) & (starts <= at + CHUNK)]
            after = starts[starts > at]
            end = before[-1] if len(before) else after[0] if len(after) else n
        over = whole or end < n
        yield t.slice(at, end - at), over
        at = end


def _written(t: pa.Table) -> bytes:
    t = t.combine_chunks()
    t = pa.table([c if n in ("rid", "draw") else c.combine_chunks().dictionary_encode() for n, c in zip(t.column_names, t.columns, strict=True)], t.column_names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by side and id as PACKED chunks; equal rows (by rid) once."""

    def out(t: pa.Table) -> pa.RecordBatch:
        rid = t["rid"].to_numpy()
        t = t.take(np.sort(np.unique(rid, return_index=True)[1]))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in ((t["side"][0].as_py(), pa.string()), (t["rid"][0].as_py(), pa.int64()), (t.num_rows, pa.int64()), (_written(t.drop_columns("side")), pa.binary()))], ["side", "chunk", "n", "data"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows > 2 * CHUNK:
            rest = None
            for t, over in _pieces(pa.Table.from_batches(held), False):
                if over:
                    yield out(t)
                else:
                    rest = t
            held = rest.to_batches() if rest is not None else []
            rows = rest.num_rows if rest is not None else 0
    if held:
        for t, _ in _pieces(pa.Table.from_batches(held), True):
            yield out(t)


@dataclass
class Chunk:
    """Records of one side: `has` and `of` of each of NUMBERS, bands of the merchant, texts as numbers into `texts`."""

    n: int
    rid: np.ndarray
    id: np.ndarray
    draw: np.ndarray
    has: dict[str, np.ndarray]
    of: dict[str, np.ndarray]
    bands: list[np.ndarray]
    has_bands: np.ndarray
    texts: list[str]
    name: np.ndarray
    slug: np.ndarray

    def take(self, rows: np.ndarray) -> Chunk:
        pick = lambda d: {k: v[rows] for k, v in d.items()}
        return Chunk(len(rows), self.rid[rows], self.id[rows], self.draw[rows], pick(self.has), pick(self.of), [b[rows] for b in self.bands], self.has_bands[rows], self.texts, self.name[rows], self.slug[rows])


def _ints(c: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    c = c.combine_chunks().dictionary_decode() if pa.types.is_dictionary(c.type) else c.combine_chunks()
    return c.is_valid().to_numpy(zero_copy_only=False), c.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def unpack(data: bytes) -> Chunk:
    t = pa.ipc.open_file(pa.BufferReader(data)).read_all()
    numbers = {c: _ints(t[c]) for c in NUMBERS}
    bands = [_ints(t[c]) for c in t.column_names if c.startswith("band_")]
    texts = {x: i for i, x in enumerate(dict.fromkeys(x for c in ("m_name", "m_slug") for x in t[c].unique().to_pylist() if x is not None))}

    def ids(c: str) -> np.ndarray:
        d = t[c].combine_chunks()
        known = np.array([texts[x] for x in d.dictionary.to_pylist()] or [0], np.int64)
        return np.where(d.indices.is_valid().to_numpy(zero_copy_only=False), known[d.indices.fill_null(0).to_numpy(zero_copy_only=False)], -1)

    plain = t["id"].combine_chunks().dictionary_decode().to_numpy(zero_copy_only=False)
    return Chunk(t.num_rows, t["rid"].to_numpy(), plain, t["draw"].to_numpy(), {c: h for c, (h, _) in numbers.items()}, {c: v for c, (_, v) in numbers.items()}, [v for _, v in bands], bands[0][0], list(texts), ids("m_name"), ids("m_slug"))


def value_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, c, v, n): how many records of each chunk have each value v of attribute c."""
    for b in batches:
        for chunk, data in zip(b["chunk"].to_pylist(), b["data"].to_pylist(), strict=True):
            x = unpack(data)
            for c in ("merchant", "issuer", "value", "spend", "kind", "until"):
                v, n = np.unique(x.of[c][x.has[c]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(v), pa.int64()), pa.array([c] * len(v), pa.string()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], ["chunk", "c", "v", "n"])


# --- pairs of a cell -------------------------------------------------------------------------------


def _mixed(key: np.ndarray, v: np.ndarray | int) -> np.ndarray:
    """The keys with one more number hashed in."""
    with np.errstate(over="ignore"):
        x = (key ^ (np.asarray(v).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def keys_of(x: Chunk, spread: int, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, row): a key for each triple of attributes that a record states, each band and each bucket of days within `spread`."""
    day = x.of["until"]
    low, high = (day - spread) // bucket, (day + spread) // bucket
    rows_all = np.arange(x.n)
    variants: list[list[tuple[np.ndarray, np.ndarray]]] = [
        [(x.has_bands, _mixed(np.full(x.n, i, np.uint64), b)) for i, b in enumerate(x.bands)],
        *[[(x.has[c], x.of[c])] for c in ("issuer", "value", "spend")],
        [(x.has["until"], low), *([(x.has["until"] & (high > low), high)] if spread else [])],
    ]
    keys, rows = [], []
    for t in combinations(range(5), 3):
        found = [(np.ones(x.n, bool), np.full(x.n, sum(1 << i for i in t), np.uint64))]
        for i in t:
            found = [(has & h, _mixed(key, v)) for has, key in found for h, v in variants[i]]
        for has, key in found:
            keys.append(key[has])
            rows.append(rows_all[has])
    return np.concatenate(keys), np.concatenate(rows)


class Index:
    """The keys of a chunk in order, each once, with the rows that have it."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(keys)
        self.rows, keys = rows[order], keys[order]
        self.starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.ends = keys[self.starts], np.append(self.starts[1:], len(keys))

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of `keys` are there, start, end of their rows)."""
        if not len(self.keys):
            return (np.zeros(0, np.int64),) * 3
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = np.flatnonzero(self.keys[at] == keys)
        return there, self.starts[at[there]], self.ends[at[there]]


def pairs_of(index: Index, n: int, keys: np.ndarray, rows: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(b, l): all pairs with a common key, each once, in order of l; the rows of one of `groups` (ascending by l) come together."""
    there, start, end = index.found(keys)
    row = rows[there]
    order = np.argsort(row, kind="stable")
    row, start, count = row[order], start[order], (end - start)[order]
    if not len(row):
        return
    group = groups[row]
    firsts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sums = np.add.reduceat(count, firsts)
    lasts = np.append(firsts[1:], len(row))
    begin, held = 0, 0
    for i in range(len(firsts)):
        held += sums[i]
        if held >= AT_ONCE or i == len(firsts) - 1:
            s = slice(firsts[begin], lasts[i])
            c = count[s]
            places = np.repeat(start[s] - (np.cumsum(c) - c), c) + np.arange(c.sum())
            code = np.unique(np.repeat(row[s], c) * n + index.rows[places])
            yield code % n, code // n
            begin, held = i + 1, 0


# --- texts -----------------------------------------------------------------------------------------


def _long_distance(a: str, b: str) -> int:
    """Edit distance by the textbook table, a row at once."""
    y = np.array([ord(c) for c in b])
    steps = np.arange(len(b) + 1)
    last = steps.copy()
    for i, c in enumerate(a):
        now = np.empty_like(last)
        now[0] = i + 1
        now[1:] = np.minimum(last[1:] + 1, last[:-1] + (y != ord(c)))
        last = np.minimum.accumulate(now - steps) + steps
    return int(last[-1])


class Texts:
    """Edit distances between the texts of a bank chunk and those of a listing chunk, by bit vectors (Myers, Hyyrö), many pairs at once."""

    def __init__(self, left: list[str], right: list[str]) -> None:
        self.left, self.right = left, right
        self.m, self.n = np.array([len(x) for x in left] or [0]), np.array([len(x) for x in right] or [0])
        letters = {c: i + 1 for i, c in enumerate(sorted({c for x in left if len(x) <= WORD for c in x}))}
        self.masks = np.zeros((max(1, len(left)), len(letters) + 1), np.uint64)  # 0: a letter that no text on the left has
        for i, x in enumerate(left):
            if len(x) <= WORD:
                for j, c in enumerate(x):
                    self.masks[i, letters[c]] |= np.uint64(1 << j)
        self.codes = np.zeros((max(1, len(right)), min(WORD, self.n.max())), np.int64)
        for i, x in enumerate(right):
            if len(x) <= WORD:
                self.codes[i, : len(x)] = [letters.get(c, 0) for c in x]

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), np.int64)
        long = (self.m[a] > WORD) | (self.n[b] > WORD)
        for i in np.flatnonzero(long):
            out[i] = _long_distance(self.left[a[i]], self.right[b[i]])
        short = np.flatnonzero(~long)
        short = short[np.argsort(-self.n[b[short]], kind="stable")]  # longest first: the pairs still at work stand in front
        for i in range(0, len(short), TEXTS_AT_ONCE):
            part = short[i : i + TEXTS_AT_ONCE]
            out[part] = self._short(a[part], b[part])
        return out

    def _short(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        one, n = np.uint64(1), self.n[b]
        score, m = self.m[a].copy(), self.m[a]
        top = (m - 1).astype(np.uint64)
        vp, vn = np.full(len(a), ~np.uint64(0)), np.zeros(len(a), np.uint64)
        for j in range(int(n[0]) if len(n) else 0):
            k = int(np.searchsorted(-n, -j, side="left"))  # those with more than j letters
            p, q = vp[:k], vn[:k]
            eq = self.masks[a[:k], self.codes[b[:k], j]]
            d = (((eq & p) + p) ^ p) | eq | q
            hp, hn = q | ~(d | p), d & p
            score[:k] += ((hp >> top[:k]) & one).astype(np.int64) - ((hn >> top[:k]) & one).astype(np.int64)
            hp, hn = (hp << one) | one, hn << one
            vp[:k], vn[:k] = hn | ~(d | hp), hp & d
        return score


# --- comparison ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """What decides whether attributes agree: likeness of merchants, days, width of a bucket; and the attributes compared, in order."""

    like: float
    unlike: float
    days: int
    bucket: int
    compared: tuple[str, ...]


def compare(b: Chunk, p: Chunk, texts: Texts, i: np.ndarray, j: np.ndarray, rare: dict[str, np.ndarray], log_n: float, rules: Rules) -> dict[str, np.ndarray]:
    """Pairs (row i of b, row j of p) with a_*, 1 where both sides state an attribute and agree, -1 where they differ, 0 where one lacks it.

    Besides: g_* how rare the bank's value is, `unlike` of the merchants' letters (nearest writings),
    `days` apart as a share of Rules.days, log_n. Merchants agree from `like` on, and differ if both are
    listed under different names or are less than `unlike`; in between, and where one begins with the
    other, it stays open (0, with `half` 1).
    """
    likes, near = np.full(len(i), -np.inf), np.zeros(len(i), bool)
    width = max(1, len(texts.right))
    written = [(x, y) for x in (b.name, b.slug) for y in (p.name, p.slug)]
    at = [np.flatnonzero((x[i] >= 0) & (y[j] >= 0)) for x, y in written]
    codes = [x[i[k]] * width + y[j[k]] for (x, y), k in zip(written, at, strict=True)]
    known, back = np.unique(np.concatenate(codes), return_inverse=True)
    left, right = known // width, known % width
    apart = texts.distances(left, right)
    m, n = texts.m[left], texts.n[right]
    like_of = 1 - apart / np.maximum(1, np.maximum(m, n))
    begins = (apart == np.abs(m - n)) & (np.minimum(m, n) >= 5)
    for k in np.flatnonzero(begins):
        x, y = texts.left[left[k]], texts.right[right[k]]
        begins[k] = x.startswith(y) or y.startswith(x)
    done = 0
    for k in at:
        part = back[done : done + len(k)]
        done += len(k)
        likes[k] = np.maximum(likes[k], like_of[part])
        near[k] |= begins[part]
    stated = likes > -np.inf
    other = b.has["listed"][i] & p.has["listed"][j] & (b.of["listed"][i] != p.of["listed"][j]) & (likes < 1)
    merchant = np.select([~stated, other, likes >= rules.like, (likes >= rules.unlike) | near], [0, -1, 1, 0], -1)
    out = {"a_merchant": merchant}
    days = np.abs(p.of["until"][j] - b.of["until"][i])
    for c in rules.compared[1:]:
        both = b.has[c][i] & p.has[c][j]
        agree = days <= rules.days if c == "until" else b.of[c][i] == p.of[c][j]
        out[f"a_{c}"] = np.where(both, np.where(agree, 1, -1), 0)
    both = b.has["until"][i] & p.has["until"][j]
    return out | {f"g_{c}": rare[c][i] for c in rules.compared} | {
        "half": ((merchant == 0) & stated).astype(float), "unlike": np.where(stated, 1 - likes, 0.0), "days": np.where(both, np.minimum(days, rules.days) / rules.days, 0.0), "log_n": np.full(len(i), log_n),
    }


def _rarity(b: Chunk, rare: list[dict] | None, every_day: float) -> dict[str, np.ndarray]:
    """For each attribute how rare each record's value is; 0 for none."""
    by: dict[str, dict[int, float]] = {}
    for r in rare or []:
        by.setdefault(r["c"], {})[r["v"]] = r["r"]
    out = {"until": np.full(b.n, every_day)}
    for c in ("merchant", "issuer", "value", "spend", "kind"):
        v, back = np.unique(b.of[c], return_inverse=True)
        out[c] = np.where(b.has[c], np.array([by.get(c, {}).get(int(x), 0.0) for x in v] or [0.0])[back] if b.n else np.zeros(0), 0.0)
    return out


def _groups(ids: np.ndarray) -> np.ndarray:
    """The number of each row's id; rows of one id stand together."""
    return np.cumsum(np.concatenate([[False], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)


def _cells(batches: Iterator[pa.RecordBatch], rules: Rules, log_n: float, every_day: float, drawn: int | None) -> Iterator[tuple[int, Chunk, Chunk, Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]]]:
    """(chunk of listings, bank, listings, their pairs as compared) for each cell; of the listings those with draw < `drawn`, if given."""
    last, p, keys, groups = None, None, None, None
    for batch in batches:
        for r in range(batch.num_rows):
            cell = {n: batch[n][r] for n in batch.schema.names}
            if (name := cell["l_chunk"].as_py()) != last:
                last, p = name, unpack(cell["l_data"].as_py())
                if drawn is not None:
                    p = p.take(np.flatnonzero(p.draw < drawn))
                keys, groups = keys_of(p, rules.days, rules.bucket), _groups(p.id)
            b = unpack(cell["b_data"].as_py())
            rare = _rarity(b, cell["rare"].as_py(), every_day)

            def compared(b: Chunk = b, p: Chunk = p, keys: tuple = keys, groups: np.ndarray = groups, rare: dict = rare) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
                if p.n and b.n:
                    texts = Texts(b.texts, p.texts)
                    for i, j in pairs_of(Index(*keys_of(b, 0, rules.bucket)), b.n, *keys, groups):
                        yield i, j, compare(b, p, texts, i, j, rare, log_n, rules)

            yield last, b, p, compared()


def compared_rows(rules: Rules, log_n: float, every_day: float, drawn: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: every pair of the cells with both ids, the rid of the listing and what `compare` gives."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, b, p, found in _cells(batches, rules, log_n, every_day, drawn):
            for i, j, x in found:
                columns = {"b_id": pa.array(b.id[i], pa.string()), "l_id": pa.array(p.id[j], pa.string()), "b": pa.array(b.rid[i], pa.int64()), "l": pa.array(p.rid[j], pa.int64())}
                columns |= {k: pa.array(v, pa.int32() if k.startswith("a_") else pa.float64()) for k, v in x.items()}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows


def best_rows(rules: Rules, log_n: float, every_day: float, odds: Callable[[dict[str, np.ndarray]], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: (l_id, odds, b_id, all) of each listing of the cells: its best pair and the sum of all its odds.

    Versions of an id stand in one chunk; a pair of ids has the best odds of its versions. Cells that
    follow each other with the same listings are put together.
    """

    def put(p: Chunk, top: np.ndarray, who: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        firsts = np.flatnonzero(np.concatenate([[True], p.id[1:] != p.id[:-1]])) if p.n else np.zeros(0, np.int64)
        some = np.flatnonzero(total > 0)
        return pa.RecordBatch.from_arrays([pa.array(p.id[firsts[some]], pa.string()), pa.array(top[some], pa.float64()), pa.array(who[some], pa.string()), pa.array(total[some], pa.float64())], ["l_id", "odds", "b_id", "all"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for name, b, p, found in _cells(batches, rules, log_n, every_day, None):
            if last is None or last[0] != name:
                if last is not None:
                    yield put(*last[1:])
                k = int(_groups(p.id)[-1]) + 1 if p.n else 0
                last = name, p, np.full(k, -1.0), np.full(k, None, object), np.zeros(k)
            _, _, top, who, total = last
            g_l, g_b = _groups(p.id), _groups(b.id)
            versions = (len(g_l) and g_l[-1] + 1 < p.n) or (len(g_b) and g_b[-1] + 1 < b.n)
            for i, j, x in found:
                z, l_, b_ = odds(x), g_l[j], i
                if versions:
                    order = np.lexsort((z, g_b[i], l_))
                    z, l_, b_ = z[order], l_[order], i[order]
                    keep = np.flatnonzero(np.concatenate([(l_[1:] != l_[:-1]) | (g_b[b_][1:] != g_b[b_][:-1]), [True]]))
                    z, l_, b_ = z[keep], l_[keep], b_[keep]
                firsts = np.flatnonzero(np.concatenate([[True], l_[1:] != l_[:-1]]))
                of = l_[firsts]
                total[of] += np.add.reduceat(z, firsts)
                most = np.maximum.reduceat(z, firsts)
                size = np.diff(np.append(firsts, len(z)))
                at = np.maximum.reduceat(np.where(z == np.repeat(most, size), np.arange(len(z)), -1), firsts)  # the last of equal ones
                names = b.id[b_[at]]
                better = (most > top[of]) | ((most == top[of]) & (names > np.where(top[of] < 0, "", who[of])))
                top[of[better]], who[of[better]] = most[better], names[better]
        if last is not None:
            yield put(*last[1:])

    return rows
