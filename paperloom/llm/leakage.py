"""Problem 7: evaluation passages inside training texts.

Items are cut into units of at most UNIT words that share all passages of up to
UNIT - UNIT_STEP words.  Units form an inverted index over shingles of three words with BM25
impacts: a posting list for every shingle, in blocks of one interval of units
each, with their largest impact.  Impacts are divided by the unit's threshold, so
a score of one is the threshold of all of them.  Every training text is cut into
overlapping windows, each a query, and all windows of a batch move through the
lists in step by block-max WAND: the pivot of a window is the first interval at
which the largest impacts left in its lists reach one, and all lists skip to it;
if the maxima of the blocks at the pivot reach one too, its units are scored.

The threshold of a unit is the least score that a leaked passage of it can have.
A passage of ``n`` words with at most one edit in ``tolerance`` words holds, for
one of the lengths ``least``, ``least + tolerance``, ... below twice ``least``, a
part with no more than a ``tolerance``-th of that length of edits; each edit
destroys at most three shingles, the heaviest at worst.  So nothing is lost
before the exact check, an edit alignment.

Up to MOST_UNITS units are one broadcast index.  More are shared out by hash to
parts of that size: one pass over the texts keeps the windows that have any
shingle of the items, told by a bit table of fixed size, and every part meets
them in groups of bounded size.

Texts are compared by words: without case, punctuation, blanks, divisions and
invisible characters, look-alike letters taken for one.  Words are compared by
64-bit hashes.

Defined results: null and empty texts, and items shorter than ``least`` words,
give no rows; repeated ids and repeated rows give one row; a repeated text
counts under each of its ids; ids may be of any type.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .lookalike import LATIN

DIVISION = re.compile(r"[-‐‑‒–¬=~­][ \t\r ]*\n\s*")
#: Words of a window and between windows: a part of at most 45 words (40 and 5 edits) lies whole in one.
WINDOW, STRIDE = 72, 28
UNIT, UNIT_STEP = 120, 80
#: Units of an interval.
BLOCK = 32
K1, B = 1.2, 0.75
#: Units indexed together (some 100 MB), words whose hashes a task keeps, bits of the table of shingles, windows a group.
MOST_UNITS, MOST_WORDS, BITS, GROUP = 30_000, 2_000_000, 27, 100_000
#: Texts looked at together.
BATCH = 500
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def normal_word(token: str) -> str:
    """A token for comparison: '' if it has no letter or digit."""
    if token.isascii():
        return token.lower() if token.isalnum() else re.sub(r"[^0-9a-z]", "", token.lower())
    token = unicodedata.normalize("NFKD", token).translate(LATIN).casefold()
    return "".join(c for c in unicodedata.normalize("NFKC", token) if c.isalnum() or unicodedata.category(c) == "Mn")


def normal_tokens(text: str) -> list[str]:
    if "&" in text:
        text = html.unescape(text)
    return DIVISION.sub("", text).split()


class Hashes(dict):
    """64-bit hash of a token's comparable form, 0 if it has none; kept for a task."""

    def __missing__(self, token: str) -> int:
        name = normal_word(token)
        self[token] = code = (xxhash.xxh3_64_intdigest(name) | 1) if name else 0
        return code

    def of(self, text: str | None) -> np.ndarray:
        if len(self) > MOST_WORDS:
            self.clear()
        x = np.fromiter(map(self.__getitem__, normal_tokens(text)), np.uint64) if text else np.zeros(0, np.uint64)
        return x[x > 0]


def shingles(x: np.ndarray) -> np.ndarray:
    """Hash of every three neighbouring words."""
    h = x[:-2] * _MIX[0]
    h = ((h ^ (h >> np.uint64(29))) + x[1:-1]) * _MIX[1]
    h = ((h ^ (h >> np.uint64(32))) + x[2:]) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def units_of(x: np.ndarray, least: int) -> list[np.ndarray]:
    """Overlapping units of an item; none if it is shorter than ``least``."""
    if len(x) < least:
        return []
    return [x[s : s + UNIT] for s in range(0, max(1, len(x) - UNIT + UNIT_STEP), UNIT_STEP) if s == 0 or len(x) - s >= least]


def least_score(weight: np.ndarray, term: np.ndarray, least: int, tolerance: int) -> float:
    """What remains of a leaked part's score, at the worst."""
    best, plain = np.inf, len(np.unique(term)) == len(term)
    for size in range(least, 2 * least, tolerance):
        if len(weight) < size - 2:
            break
        lost = 3 * (size // tolerance)
        spans = np.lib.stride_tricks.sliding_window_view(weight, size - 2)
        if plain:
            kept = np.sort(spans, axis=1)[:, : max(1, size - 2 - lost)].sum(axis=1)
            best = min(best, kept.min())
            continue
        for w, t in zip(spans, np.lib.stride_tricks.sliding_window_view(term, size - 2)):
            few = np.sort(w[np.unique(t, return_index=True)[1]])  # a repeated shingle counts once in a window
            best = min(best, few[: max(1, len(few) - lost)].sum())
    return float(best)


class ItemIndex:
    """Posting lists of the units of items."""

    def __init__(self, items: list[tuple[object, str]], least: int, tolerance: int):
        self.least, self.tolerance = least, tolerance
        hashes = Hashes()
        owned = [(i, u) for i, text in items for u in units_of(hashes.of(text), least)]
        self.ids = [i for i, _ in owned]
        self.size = np.array([len(u) for _, u in owned], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.size)])
        self.word = np.concatenate([u for _, u in owned]) if owned else np.zeros(0, np.uint64)
        grams = [shingles(u) for _, u in owned]
        n = len(owned)
        self.terms = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        places = [np.searchsorted(self.terms, g) for g in grams]
        counted = [np.unique(p, return_counts=True) for p in places]
        frequency = np.bincount(np.concatenate([t for t, _ in counted]), minlength=len(self.terms)) if n else np.zeros(0)
        idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
        mean = self.size.mean() if n else 1.0
        term, unit, impact = [], [], []
        for k, (p, (t, tf)) in enumerate(zip(places, counted)):
            w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * self.size[k] / mean))
            term.append(t)
            unit.append(np.full(len(t), k))
            impact.append(w / least_score(w[np.searchsorted(t, p)], p, least, tolerance))
        flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        term, unit, impact = flat(term, np.int64), flat(unit, np.int64), flat(impact, np.float64)
        order = np.lexsort((unit, term))
        self.intervals = max(1, -(-n // BLOCK))
        self.unit, self.impact = unit[order], impact[order]
        term = term[order]
        block = term * self.intervals + self.unit // BLOCK
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if n else np.zeros(0, np.int64)
        self.block = block[first]  # sorted: the blocks of a list, then those of the next list
        self.block_start = np.append(first, len(order))
        self.start = np.searchsorted(self.block // self.intervals, np.arange(len(self.terms) + 1))
        if n:
            self.block_most = np.maximum.reduceat(self.impact, first)
            # The largest impact from each block to the end of its list; lists are kept apart by a step.
            step = (len(self.terms) - self.block // self.intervals) * (self.impact.max() + 1)
            self.rest = np.maximum.accumulate((self.block_most + step)[::-1])[::-1] - step + 1e-6
            self.most = self.rest[self.start[:-1]]
        self.seen = bit_table(self.terms, max(10, min(BITS, int(np.log2(max(1, len(self.terms)))) + 5)))

    def hits(self, x: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles of one text that the index has, and their terms."""
        if len(x) < 3 or not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        gram = shingles(x)
        at = np.flatnonzero(probe(self.seen, gram) & (text[:-2] == text[2:]))
        term = np.minimum(np.searchsorted(self.terms, gram[at]), len(self.terms) - 1)
        real = self.terms[term] == gram[at]
        return at[real], term[real]

    def retrieve(self, query: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries and units with a score of the threshold or above; ``query`` is sorted, its terms are distinct."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        enough = 1 - 1e-9  # sums of the same impacts in another order may differ
        cursor, ends = self.start[term], self.start[term + 1]
        while len(query):
            cur = self.block[cursor] - term * self.intervals
            order = np.argsort(query * self.intervals + cur, kind="stable")
            query, term, cursor, ends, cur = query[order], term[order], cursor[order], ends[order], cur[order]
            begin = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
            size = np.diff(np.append(begin, len(query)))
            of = np.repeat(np.arange(len(begin)), size)
            rest = self.rest[cursor]
            bound = np.cumsum(rest)
            bound -= np.repeat(bound[begin] - rest[begin], size)
            at = np.minimum.reduceat(np.where(bound >= enough, np.arange(len(query)), len(query)), begin)
            live = at < len(query)
            pivot = np.where(live, cur[np.minimum(at, len(query) - 1)], -1)[of]
            late = np.flatnonzero(cur < pivot)  # lists before the pivot skip to it
            cursor[late] = np.searchsorted(self.block, term[late] * self.intervals + pivot[late])
            place = np.minimum(cursor, len(self.block) - 1)
            here = (cursor < ends) & (cur <= pivot) & (self.block[place] == term * self.intervals + pivot)
            maxima = np.add.reduceat(np.where(here, self.block_most[place], 0.0), begin)
            on = np.flatnonzero(here & (maxima >= enough)[of])
            if len(on):
                low = self.block_start[cursor[on]]
                many = self.block_start[cursor[on] + 1] - low
                before = np.cumsum(many) - many
                posting = np.repeat(low - before, many) + np.arange(many.sum())
                cell = np.repeat(of[on] * BLOCK, many) + self.unit[posting] % BLOCK
                score = np.bincount(cell, self.impact[posting])
                good = np.flatnonzero(score >= enough)
                found.append((query[begin[good // BLOCK]], pivot[begin[good // BLOCK]] * BLOCK + good % BLOCK))
            cursor[here] += 1
            stay = live[of] & (cursor < ends)
            query, term, cursor, ends = query[stay], term[stay], cursor[stay], ends[stay]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([u for _, u in found])

    def leaked(self, x: np.ndarray, text: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int]]:
        """(text, unit) of verified passages in a batch of texts laid end to end."""
        at, term = self.hits(x, text)
        if not len(at):
            return set()
        # Windows lie on one grid over the batch; a window has the shingles that begin in it, of one text.
        rows, many = len(ends), len(self.terms)
        steps = -(-WINDOW // STRIDE)
        grid = at // STRIDE
        keys = []
        for k in range(steps):
            inside = (grid >= k) & (at + 2 < (grid - k) * STRIDE + WINDOW)
            keys.append(((grid - k) * rows + text[at])[inside] * many + term[inside])
        key = np.unique(np.concatenate(keys))  # a shingle once a window
        cell, term = np.divmod(key, many)
        begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        size = np.diff(np.append(begin, len(cell)))
        may = np.add.reduceat(self.most[term], begin) >= 1 - 1e-9  # else no pivot exists
        keep = np.repeat(may, size)
        window, row = np.divmod(cell[begin[may]], rows)
        window *= STRIDE
        query, unit = self.retrieve(np.repeat(np.arange(may.sum()), size[may]), term[keep])
        order = np.lexsort((query, unit, self.size[unit]))
        query, unit = query[order], unit[order]
        hits: set[tuple[int, int]] = set()
        for s in range(0, len(unit), 2000):
            start, r, u = window[query[s : s + 2000]], row[query[s : s + 2000]], unit[s : s + 2000]
            todo = np.array([p not in hits for p in zip(r.tolist(), u.tolist())])
            start, r, u = start[todo], r[todo], u[todo]
            if not len(u):
                continue
            spot = start[:, None] + np.arange(WINDOW)
            inside = (spot < ends[r][:, None]) & (spot >= (ends[r] - sizes[r])[:, None])
            good = self.verify(np.where(inside, x[np.minimum(spot, len(x) - 1)], 0), u)
            hits.update(zip(r[good].tolist(), u[good].tolist()))
        return hits

    def verify(self, windows: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Does the window hold ``least`` or more words of the item with at most one edit in ``tolerance``?

        reach[e][i, j]: the longest span of the item that ends at word i, aligned
        to words of the window up to j with at most e edits.
        """
        width = windows.shape[1]
        longest = int(self.size[items].max())
        spot = self.offset[items][:, None] + np.arange(longest)
        inside = np.arange(longest) < self.size[items][:, None]
        padded = np.where(inside, self.word[np.minimum(spot, len(self.word) - 1)], 0)  # no word has the hash 0
        runs = -(-(self.least - self.least // self.tolerance) // (self.least // self.tolerance + 1))
        #: What e edits must reach if more are to reach a passage: the best e + 1 neighbours of its runs of equal words.
        needed = np.maximum(1, np.array([runs, 2 * runs - 2, 2 * runs])) if self.least >= 2 * self.tolerance else np.ones(1, int)
        good = np.zeros(len(windows), bool)
        alive = np.arange(len(windows))
        below = None
        for e in range(width // self.tolerance + 1):
            rows, seen = padded[alive], windows[alive]
            now = np.zeros((rows.shape[1] + 1, len(alive), width + 1), np.uint8)
            for i in range(rows.shape[1]):
                word = rows[:, i : i + 1]
                live = word > 0
                same = (seen == word) & live
                step = now[i, :, :-1] + np.uint8(1)
                if e:
                    other = np.maximum(below[i, :, :-1], below[i, :, 1:]) + np.uint8(1)
                    best = np.maximum(np.where(same, np.maximum(step, other), other), below[i + 1, :, :-1])
                    now[i + 1, :, 1:] = np.where(live, best, 0)
                else:
                    now[i + 1, :, 1:] = np.where(same, step, 0)
            reach = now.max(axis=(0, 2))
            good[alive[reach >= max(self.least, e * self.tolerance)]] = True
            on = (reach >= needed[min(e, len(needed) - 1)]) & ~good[alive]
            alive, below = alive[on], now[:, on]
            if not len(alive):
                break
        return good


def bit_table(grams: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(1 << (bits - 3), np.uint8)
    place = grams >> np.uint64(64 - bits)
    np.bitwise_or.at(out, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    return out


def probe(table: np.ndarray, grams: np.ndarray) -> np.ndarray:
    place = grams >> np.uint64(64 - (len(table).bit_length() + 2))
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def batch_of(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts end to end, the text of each, and the ends and sizes of the texts."""
    sizes = np.array([len(x) for x in parts], np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.repeat(np.arange(len(parts)), sizes), np.cumsum(sizes), sizes


def leaked_items(documents: DataFrame, items: DataFrame, least: int = 24, tolerance: int = 8, most_units: int = MOST_UNITS) -> DataFrame:
    """``item_id, doc_id`` of every text that holds a passage of an item."""
    wanted = items.select("item_id", F.col("text").cast("string").alias("text")).filter("item_id is not null and text is not null").distinct()
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    ids = f"item_id {items.schema['item_id'].dataType.simpleString()}, doc_id {documents.schema['doc_id'].dataType.simpleString()}"
    units = wanted.agg(F.sum(F.ceil(F.length("text") / (2 * UNIT_STEP)))).first()[0] or 0  # a word takes two characters at least
    if units <= most_units:
        return _whole(texts, [(r.item_id, r.text) for r in wanted.collect()], ids, least, tolerance).distinct()
    return _parted(texts, wanted, ids, least, tolerance, -(-units // most_units)).distinct()


def _rows(ids: pa.DataType, index: ItemIndex, documents: pa.Array, hits: set[tuple[int, int]]) -> pa.RecordBatch:
    rows, units = zip(*sorted(hits))
    return pa.RecordBatch.from_arrays([pa.array([index.ids[u] for u in units], ids), documents.take(pa.array(rows))], ["item_id", "doc_id"])


def _whole(texts: DataFrame, items: list[tuple[object, str]], ids: str, least: int, tolerance: int) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(ItemIndex(items, least, tolerance))  # at most ``most_units`` units
    item_type = _arrow(texts, ids).field("item_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, words = shared.value, Hashes()
        for b in batches:
            for s in range(0, b.num_rows, BATCH):
                part = b.slice(s, BATCH)
                if hits := index.leaked(*batch_of([words.of(t) for t in part.column(1).to_pylist()])):
                    yield _rows(item_type, index, part.column(0), hits)

    return texts.mapInArrow(run, ids)


def _parted(texts: DataFrame, wanted: DataFrame, ids: str, least: int, tolerance: int, parts: int) -> DataFrame:
    spark = texts.sparkSession

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Hashes()
        for b in batches:
            x, text, _, _ = batch_of([words.of(t) for t in b.column(0).to_pylist()])
            gram = np.unique(shingles(x)[text[:-2] == text[2:]] >> np.uint64(64 - BITS)).astype(np.int64) if len(x) > 2 else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(gram >> 6), pa.array((np.uint64(1) << (gram & 63).astype(np.uint64)).view(np.int64))], ["at", "mask"])

    made = wanted.select("text").mapInArrow(bits, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most 2 ** (BITS - 6) rows
    table = np.zeros(1 << (BITS - 6), np.int64)
    table[made.column("at").to_numpy()] = made.column("mask").to_numpy()
    shared = spark.sparkContext.broadcast(table.view(np.uint8))
    doc = ids.split(", ")[1]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Hashes()
        for b in batches:
            docs, cut = [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                x = words.of(t)
                if len(x) < 3:
                    continue
                seen = np.flatnonzero(probe(shared.value, shingles(x)))
                for g in np.unique(seen // STRIDE).tolist():
                    docs.append(k)
                    cut.append(x[max(0, g * STRIDE - WINDOW + STRIDE) : g * STRIDE + WINDOW].view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(c) for c in cut])]), pa.int32()), pa.array(np.concatenate(cut) if cut else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(docs, pa.int64())), lists], ["doc_id", "words"])

    windows = checkpoint(texts.mapInArrow(keep, f"{doc}, words array<long>"))
    salts = -(-windows.count() // GROUP) or 1
    every = windows.withColumn("salt", F.pmod(F.xxhash64("words"), F.lit(salts))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    held = wanted.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    item_type = _arrow(texts, ids).field("item_id").type
    empty = _arrow(texts, ids).empty_table()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        index = ItemIndex(list(zip(right.column("item_id").to_pylist(), right.column("text").to_pylist())), least, tolerance)
        out = []
        for b in left.to_batches(max_chunksize=4 * BATCH):
            if hits := index.leaked(*batch_of([np.array(w, np.int64).view(np.uint64) for w in b.column("words").to_pylist()])):
                out.append(_rows(item_type, index, b.column("doc_id"), hits))
        return pa.Table.from_batches(out).cast(empty.schema) if out else empty

    return every.groupBy("part", "salt").cogroup(held.groupBy("part", "salt")).applyInArrow(meet, ids)


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)
