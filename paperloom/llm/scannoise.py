"""Problem 5: noise in text from scanned pages, and the paragraphs without it.

Skip-gram vectors are learnt from all words: pairs of neighbours within two
words are counted over the whole corpus, and the positive pointwise mutual
information of the pairs is factored into vectors of words and of contexts.
Forms that are frequent in their script have vectors of their own; rare ones
share the vectors of their kind of writing and ending, so every word is a context.

A token that is no frequent form is linked to frequent ones by plausible glyph
edits.  Of these corrections the one whose vector fits the context vectors of
the neighbours best is taken, if it fits well enough: better, where the token
may be a name, than the name's own kind.  Numbers are forms too, every digit
being one.  A frequent form is linked to a far more frequent one if glyph edits
lead there, its contexts are the other's and the vectors are near.

A piece at a line's end is joined with the next line's first word: the sign
vanishes unless the parts form a known compound, a date, a reference or a name
of two parts.  Furniture stands in those hundredths of the page's height whose
blocks repeat in their scans or are page numbers, learnt from all pages; page
numbers are told by their form, running headers by repetition, by style, by what
follows and, last, by the layout's witness.

Defined results: null and empty values are no cases; words without geometry are
placed by their block's others or by block order; junk pages give no cases; a
word divided between two blocks or pages is not joined.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import first_delivery
from ..session import checkpoint
from .lookalike import IGNORABLE, script_of, visible
from .pagestream import CHUNK_LINES, Lookup, chunk_words, edge, starts, word_tables
from .quality import WORD

#: True glyphs and what they are misread as (fixed values).
GLYPHS = [
    ("e", "c"), ("o", "a"), ("l", "1"), ("o", "0"), ("O", "0"), ("t", "f"), ("i", "1"), ("I", "1"), ("s", "5"), ("S", "5"), ("g", "q"), ("h", "b"), ("z", "2"), ("Z", "2"), ("B", "8"), ("b", "6"),
    ("n", "ri"), ("m", "rn"), ("u", "ii"), ("d", "cl"), ("w", "vv"), ("i", "l"), ("g", "9"), ("п", "н"), ("и", "н"), ("з", "3"), ("a", "α"), ("σ", "6"), ("α", "8"), ("ε", "3"), ("r", "n"), ("u", "v"), ("T", "7"), ("G", "6"), ("l", "I"),
    ("rn", "m"), ("cl", "d"), ("ii", "u"), ("vv", "w"), ("u\u0308", "ii"), ("e\u0301", "6"), ("б", "6"), ("ι", "1"),
]
BOTH = {("e", "c"), ("o", "a"), ("t", "f"), ("g", "q"), ("h", "b"), ("п", "н"), ("и", "н"), ("i", "l"), ("u", "v")}
UNDO = sorted({(bad, good) for good, bad in GLYPHS} | {(a, b) for a, b in BOTH} | {(good, bad) for good, bad in GLYPHS if bad.isdigit()}, key=lambda x: (-len(x[0]), x))
SIGNS = "‐‑¬=~­-"
PAGE_WORDS = "page seite bladzijde página pagina страница стр σελίδα σελ pág pag blz p s σ c".split()
CONNECTORS = {"of", "von", "van", "de", "di", "из", "από", "sur", "из".translate({1080: "и"})}
EDGE = re.compile("^[\\W_]+|(?:(?![\u0300-\u036f])[\\W_])+$")
NUMBER = re.compile(r"[\W_]*(?:\d{1,4}|[ivxlc]{1,6}|[IVXLC]{1,6}|\d{1,4}/\d{1,4})[\W_]*")
DATE = re.compile(r"\d{1,4}[./-]\d{1,2}[./-]\d{1,4}")
WINDOW, DIMENSIONS = 2, 96
#: By how much a correction must fit its context better than a name would, where the token is short and capitalised; how much worse than what it looks like, where a digit is exchanged.
NAME_LEAD, NUMBER_LAG = 0.3, 1.0
#: Parts of a page's height that count as its top and bottom, and the share of repeated blocks that makes a hundredth of the height a place of furniture.
OUTER, FURNITURE = 0.15, 0.3


def core(value: str) -> str:
    """A word without the marks around it, its look-alikes by their class."""
    return EDGE.sub("", visible(value))


def shape(form: str) -> str:
    """In lower case; the digits of numbers and references, not those inside a word, are all 9."""
    return form.lower() if form.isalpha() or mixed(form) else re.sub(r"\d", "9", form.lower())


def undone(form: str) -> Iterator[str]:
    """The form with one glyph misreading taken back."""
    for bad, good in UNDO:
        k = form.find(bad)
        while k >= 0:
            yield form[:k] + good + form[k + len(bad) :]
            k = form.find(bad, k + 1)


def form_of(value: str) -> str:
    """A token as the vocabulary knows it: without marks and case, a number's digits all 9; '' if nothing is left."""
    return shape(core(value))


def bucket_of(form: str) -> str:
    """What rare forms share: a vector for their kind of writing and ending."""
    if any(c.isdigit() for c in form):
        return "<9a>" if any(c.isalpha() for c in form) else "<9>"
    scripts = {script_of(c) for c in form}
    return f"<{'G' if 'G' in scripts else 'C' if 'C' in scripts else 'L'}{form[-1:]}>" if form else "<>"


@dataclass
class Model:
    """Vocabulary with skip-gram vectors; ``count`` by form, buckets included."""

    count: dict[str, int]
    word: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.float32))
    context: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.float32))
    linked: dict[str, str] = field(default_factory=dict)
    least: float = -np.inf

    def __post_init__(self) -> None:
        self.code = {f: i for i, f in enumerate(sorted(self.count))}
        self.settle()

    def settle(self) -> None:
        """What one misreading makes of the longer forms."""
        self.memo: dict[str, tuple[str, ...]] = {}
        self.once: set[str] = set()
        for f in self.count:
            if len(f) >= 6 and f not in self.linked and f[0] != "<":
                for bad, good in UNDO:
                    k = f.find(good.lower())
                    while k >= 0:
                        self.once.add(f[:k] + bad.lower() + f[k + len(good) :])
                        k = f.find(good.lower(), k + 1)

    def known(self, text: str) -> bool:
        form = shape(text)
        return form in self.count and form not in self.linked

    def code_of(self, form: str) -> int:
        """Code of a form, or of the bucket of a rare one; -1 for no form."""
        return self.code.get(form, self.code.get(bucket_of(form), -1)) if form else -1

    def corrections(self, text: str) -> tuple[str, ...]:
        """Known texts that one glyph edit away, or two in a long word, most frequent first."""
        if (link := self.linked.get(shape(text))) is not None:
            return tuple(f for f in undone(text) if shape(f) == link)[:1] or (link,)
        if (done := self.memo.get(text)) is None:
            near = set(undone(text))
            found = {f for f in near if self.known(f)}
            if not found and len(text) >= 7:
                found = {g for f in near if shape(f) in self.once for g in undone(f) if self.known(g)}
            if not found and mixed(text):  # a digit inside a name: the name's kind of writing is its candidate
                found = {f for f in near if not any(c.isdigit() for c in f)}
            even = lambda f: f[1:].islower() or f.isupper()
            found = {f.lower(): f for f in sorted(found, key=lambda f: (even(f), f))}.values()  # a digit stands for either case
            done = tuple(sorted(found, key=lambda f: (-self.count.get(shape(f), 0), f)))
            if len(self.memo) > 300_000:
                self.memo.clear()
            self.memo[text] = done
        return done

    def fit(self, code: int, around: np.ndarray) -> float:
        """Mean score of a form's vector against the context vectors of its neighbours; 0 without any."""
        return float((self.context[around] @ self.word[code]).mean()) if code >= 0 and len(around) else 0.0


def mixed(text: str) -> bool:
    """Letters with one or two digits among them that are misread letters."""
    letters, digits = sum(map(str.isalpha, text)), [c for c in text if c.isdigit()]
    return 0 < len(digits) <= 2 < letters and letters + len(digits) >= len(text) - 1 and all(c in "0125689" for c in digits)


def _tally(batches: Iterator[pa.RecordBatch], tell: Callable[[pa.RecordBatch], Iterator[tuple[str, int]]]) -> Iterator[pa.RecordBatch]:
    """Sums of keys, passed on whenever a task holds many."""
    total: dict[str, int] = {}
    out = lambda: pa.RecordBatch.from_arrays([pa.array(total, pa.string()), pa.array(total.values(), pa.int64())], ["form", "n"])
    for b in batches:
        for k, n in tell(b):
            total[k] = total.get(k, 0) + n
        if len(total) > 500_000:
            yield out()
            total.clear()
    yield out()


def learn(words: DataFrame, share: float = 0.0015, number_share: float = 0.01, pair_share: float = 0.0001, ratio: float = 12.0, rare: float = 0.01) -> Model:
    """Vocabulary, skip-gram vectors and links.

    Kept are forms with ``share`` occurrences a page of their script (numbers:
    ``number_share`` a page), counted
    over all words after their marks and look-alikes are gone: ten thousands at
    most, whatever the corpus.  All other forms go into buckets, so every word
    is a context and has a vector.  ``rare``: share of true occurrences whose
    fit may lie below the least one.
    """
    spoken = words.filter("value is not null and value != ''")
    pages = words.agg(F.approx_count_distinct("page_id")).first()[0]

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tell(b: pa.RecordBatch) -> Iterator[tuple[str, int]]:
            for r in b.column(0).value_counts().to_pylist():
                if f := form_of(r["values"]):
                    yield f, r["counts"]

        return _tally(batches, tell)

    counted = spoken.select("value").mapInArrow(forms, "form string, n long").groupBy("form").agg(F.sum("n").alias("n"))
    script = F.when(F.col("form").rlike("[0-9]"), "9").when(F.col("form").rlike(r"\p{IsCyrillic}"), "C").when(F.col("form").rlike(r"\p{IsGreek}"), "G").otherwise("L").alias("script")
    counted = checkpoint(counted.select("form", "n", script))
    sizes = {r.script: r.n for r in counted.groupBy("script").agg(F.sum("n").alias("n")).collect()}
    total = max(1, sum(sizes.values()))
    least = lambda s: max(3, number_share * pages if s == "9" else share * pages * sizes[s] / total)
    keep = F.coalesce(*(F.when(F.col("script") == s, F.col("n") >= least(s)) for s in sizes), F.lit(False)) if sizes else F.lit(False)
    count = {r.form: r.n for r in counted.filter(keep).collect()}
    if not count:
        return Model({})
    buckets = counted.filter(~keep).select("form", "n").mapInArrow(lambda bs: _tally(bs, lambda b: ((bucket_of(f), n) for f, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))), "form string, n long")
    count |= {r.form: r.n for r in buckets.groupBy("form").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(3, share * pages)).collect()}
    model = Model(count)
    shared = words.sparkSession.sparkContext.broadcast(model)
    size = len(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        m = shared.value
        look_up = Lookup(lambda vs: np.array([m.code_of(form_of(v)) for v in vs], np.int64))
        out = lambda: pa.RecordBatch.from_arrays([pa.array(total, pa.int64()), pa.array(total.values(), pa.int64())], ["pair", "n"])
        for t in word_tables(batches, 4000):
            c = look_up(t.column("value"))
            block = np.cumsum(starts(*(t.column(k).to_numpy() for k in ("page_id", "block_idx", "chunk", "part"))))
            found = []
            for d in range(1, WINDOW + 1):
                a, b = c[:-d], c[d:]
                ok = (a >= 0) & (b >= 0) & (block[:-d] == block[d:])
                found.append(np.minimum(a[ok], b[ok]) * size + np.maximum(a[ok], b[ok]))  # either order, told once
            for k, n in zip(*(x.tolist() for x in np.unique(np.concatenate(found), return_counts=True))):
                total[k] = total.get(k, 0) + n
            if len(total) > 1_000_000:
                yield out()
                total.clear()
        yield out()

    pairs = chunk_words(spoken, value=F.col("value")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").cast("int").alias("n")).filter(F.col("n") >= max(2, pair_share * pages)).toArrow()
    pair, n = pairs.column("pair").to_numpy(), pairs.column("n").to_numpy().astype(np.int64)
    if not len(pair):
        return model
    a, b = np.divmod(pair, size)
    a, b, n = np.append(a, b), np.append(b, a), np.append(n, n)  # both ways; what stands beside its like counts for both
    order = np.argsort(a * size + b, kind="stable")
    a, b, n = a[order], b[order], n[order]
    twice = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]))
    n[:-1] += np.where(twice[1:], n[1:], 0)
    a, b, n = a[~twice], b[~twice], n[~twice]
    model.word, model.context = skip_gram_vectors(a, b, n, size)
    model.linked = _links(model, a, b, n, ratio)
    model.least = true_fit(model, a, b, n, rare)
    model.settle()
    return model


def skip_gram_vectors(a: np.ndarray, b: np.ndarray, n: np.ndarray, size: int, dimensions: int = DIMENSIONS, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of words and of contexts whose products are the positive pointwise mutual information of the pairs.

    This is what skip-gram training with negative samples converges to.  The
    factors come from subspace iteration on the sparse, symmetric matrix.
    """
    row, total = np.bincount(a, n, size), n.sum()
    value = np.maximum(0, np.log(n * total / (row[a] * row[b]))).astype(np.float32)
    first = np.searchsorted(a, np.arange(size))
    filled = np.flatnonzero(np.append(first[1:], len(a)) > first)

    def times(x: np.ndarray) -> np.ndarray:
        out = np.zeros((size, x.shape[1]), np.float32)
        for s in range(0, len(filled), 2000):
            rows = filled[s : s + 2000]
            low, high = first[rows[0]], np.append(first, len(a))[rows[-1] + 1]
            out[rows] = np.add.reduceat(value[low:high, None] * x[b[low:high]], first[rows] - low, axis=0)
        return out

    k = min(dimensions, size)
    q = np.linalg.qr(np.random.default_rng(7).normal(size=(size, k)).astype(np.float32))[0]
    for _ in range(rounds):
        q = np.linalg.qr(times(q))[0]
    small = q.T @ times(q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    word = (q @ turn) * np.sqrt(np.abs(values))
    return word.astype(np.float32), (word * np.sign(values)).astype(np.float32)


def true_fit(model: Model, a: np.ndarray, b: np.ndarray, n: np.ndarray, rare: float) -> float:
    """The fit below which only ``rare`` of the occurrences in the corpus lie."""
    fit = np.concatenate([np.einsum("ij,ij->i", model.word[a[s : s + 100_000]], model.context[b[s : s + 100_000]]) for s in range(0, len(a), 100_000)])
    order = np.argsort(fit)
    return float(fit[order][np.searchsorted(np.cumsum(n[order]), rare * n.sum())])


def _links(model: Model, a: np.ndarray, b: np.ndarray, n: np.ndarray, ratio: float) -> dict[str, str]:
    """Vocabulary forms that are misreadings of a far more frequent form: its contexts are theirs, and its vector near."""
    size = len(model.code)
    pairs = a * size + b
    length = np.linalg.norm(model.word, axis=1) + 1e-9
    edge_of = np.searchsorted(a, np.arange(size + 1))
    linked = {}
    for f, k in model.code.items():
        if len(f) < 3 or f[0] == "<":
            continue
        best = max((g for g in map(str.lower, undone(f)) if model.count.get(g, 0) >= ratio * model.count[f]), key=lambda g: model.count[g], default=None)
        own = slice(edge_of[k], edge_of[k + 1])
        if best is None or not n[own].sum():
            continue
        wanted = model.code[best] * size + b[own]
        at = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
        shared = n[own][pairs[at] == wanted].sum() / n[own].sum()
        near = float(model.word[k] @ model.word[model.code[best]]) / length[k] / length[model.code[best]]
        if (shared >= 0.9 and near >= 0.1) or (shared >= 0.7 and near >= 0.45):
            linked[f] = best
    return linked


def page_number_part(values: list[str]) -> list[bool]:
    """Which words of a line belong to a page number at its start or end."""
    kinds = ""
    for i, v in enumerate(values):
        v = visible(v)
        c = EDGE.sub("", v).lower()
        if v and not c:
            kinds += "B" if v == "|" else "D"
        elif c in _PAGE or (len(c) >= 4 and any(len(c) == len(w) and sum(x != y for x, y in zip(c, w)) == 1 for w in _PAGE)):
            kinds += "W"
        elif NUMBER.fullmatch(v) and not (i == 0 and len(values) > 1 and re.fullmatch(r"\d+[.)]", v)):
            kinds += "N"
        else:
            kinds += "C" if c in _CONNECT else "X"
    group = r"DND|NBN|W?N(?:[CD]N)?|W"
    found = re.search(rf"(?:{group})$", kinds) or re.match(group, kinds)
    if found and "N" in found[0]:
        return [found.start() <= i < found.end() for i in range(len(values))]
    return [False] * len(values)


_PAGE, _CONNECT = {visible(w) for w in PAGE_WORDS}, {visible(w) for w in CONNECTORS}
SCHEMA = "what string, page_id {page}, block_idx int, word_ids array<long>, line string, number_ids array<long>, y0 float, y1 float, known double, size double"


def findings(words: DataFrame, model: Model) -> DataFrame:
    """What the words of a block tell alone: pieces, misreadings, lines that may be furniture, and counts."""
    shared = words.sparkSession.sparkContext.broadcast(model)
    g = F.col("geometry")
    rows = chunk_words(words, ahead=True, value=F.col("value"), y0=edge(g, 1, False), y1=edge(g, 1, True))

    from pyspark.sql.pandas.types import to_arrow_schema

    ddl = SCHEMA.format(page=words.schema["page_id"].dataType.simpleString())
    target = to_arrow_schema(words.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        look_up = Lookup(lambda vs: _traits(m, vs))
        for t in word_tables(batches):
            page, block, chunk, line, ids = (t.column(c).to_numpy() for c in ("page_id", "block_idx", "chunk", "line_idx", "word_id"))
            y0, y1 = t.column("y0").to_numpy(), t.column("y1").to_numpy()
            value = [v or "" for v in t.column("value").to_pylist()]
            traits = look_up(t.column("value"))
            own = line < (chunk + 1) * CHUNK_LINES
            out: dict[str, list] = defaultdict(list)

            def tell(what, i, word_ids, text=None, numbers=None, top=None, bottom=None, known=0.0, size=0.0):
                for k, v in zip(target.names, (what, page[i], block[i], word_ids, text, numbers, top, bottom, known, size)):
                    out[k].append(v)  # noqa: B023

            new_chunk = starts(page, block, chunk, t.column("part").to_numpy())
            new_line = new_chunk | starts(line)
            at = np.flatnonzero(new_chunk)
            for s, e in zip(at.tolist(), [*at[1:].tolist(), len(page)]):
                mine = own[s:e]
                tell("count", s, [], known=float(traits[s:e, 0][mine].sum()), size=float(traits[s:e, 1][mine].sum()))
                if chunk[s] == 0 and line[e - 1] < CHUNK_LINES:
                    top = float(np.nanmin(y0[s:e])) if np.isfinite(y0[s:e]).any() else None
                    bottom = float(np.nanmax(y1[s:e])) if np.isfinite(y1[s:e]).any() else None
                    if top is None or bottom is None or bottom <= OUTER or top >= 1 - OUTER:
                        cuts = [s, *(np.flatnonzero(new_line[s + 1 : e]) + s + 1).tolist(), e]
                        part = [x for i, j in zip(cuts, cuts[1:]) for x in page_number_part(value[i:j])]
                        rest = " ".join(v for v, n in zip(value[s:e], part) if not n)
                        tell("line", s, ids[s:e].tolist(), rest, [int(i) for i, n in zip(ids[s:e], part) if n], top, bottom, known=float(len(cuts) - 1))
            # Pieces at line ends.
            pieces = np.zeros(len(page), bool)
            ends = np.flatnonzero(np.append(new_line[1:], True) & own)
            for i in ends[traits[ends, 2] > 0].tolist():
                j = i + 1
                if j < len(page) and not new_chunk[j] and line[j] == line[i] + 1:
                    vanishes, bad = divided(m, value[i], value[j])
                    pieces[i] = pieces[j] = True
                    if vanishes:
                        tell("hyphen", i, [int(ids[i])])
                    if bad is not None:
                        tell("misread", i, [int(ids[i if bad == 0 else j])])
                else:
                    pieces[i] = True
            # Misread words: the correction that fits the context best.
            code, of = traits[:, 4].astype(np.int64), np.cumsum(new_chunk)
            for i in np.flatnonzero((traits[:, 3] > 0) & own & ~pieces).tolist():
                low, high = max(0, i - WINDOW), min(len(page), i + WINDOW + 1)
                near = (of[low:high] == of[i]) & (code[low:high] >= 0)
                near[i - low] = False
                if (found := corrected(m, core(value[i]), code[low:high][near])) is not None:
                    tell("misread", i, [int(ids[i])], visible(value[i]).replace(core(value[i]), found, 1))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return rows.mapInArrow(run, ddl)


def _traits(m: Model, values: list[str]) -> np.ndarray:
    """Known (0/1), weight, ends with a division sign, has corrections, code."""
    out = np.zeros((len(values), 5), np.float32)
    for k, v in enumerate(values):
        form = core(v)
        known = bool(form) and m.known(form)
        tail = "".join(c for c in v.rstrip() if c in SIGNS or (ord(c) not in IGNORABLE and c.isprintable()))
        odd = len(form) > 1 and not known and bool(m.corrections(form))
        out[k] = known and not any(c.isdigit() for c in form), 1.0 if WORD.search(v) else 0.3, len(tail) > 1 and tail[-1] in SIGNS and bool(form), odd, m.code_of(form_of(v))
    return out


def corrected(m: Model, form: str, around: np.ndarray) -> str | None:
    """What an unknown form should be here, None if it is likelier what it looks like.

    Of the corrections, all plausible glyph edits, the one whose vector fits the
    context vectors of the neighbours best is taken.
    """
    fit, best = max(((m.fit(m.code_of(shape(f)), around), f) for f in m.corrections(form)), key=lambda x: x[0])
    own = lambda: m.fit(m.code.get(bucket_of(shape(form)), -1), around)
    if any(c.isdigit() for c in form):
        return best if len(form) >= 3 and fit >= own() - NUMBER_LAG else None
    if any(c.isdigit() for c in best):
        return best if sum(map(str.isdigit, best)) > 2 and fit >= own() - NUMBER_LAG else None
    if form[0].islower() or len(form) >= 7 or shape(form) in m.linked:
        return best if (fit >= m.least or not len(around)) and len(form) >= 3 else None
    return best if fit >= max(0.0, own() + NAME_LEAD) else None


def divided(m: Model, first: str, second: str) -> tuple[bool, int | None]:
    """Does the sign vanish when the pieces are joined, and which piece, if any, is misread?"""
    sign = [c for c in first.rstrip() if c in SIGNS or (ord(c) not in IGNORABLE and c.isprintable())][-1]
    a, b = core(first), core(second)
    if not b:
        return sign not in "-‐‑", None
    whole, held = a + b, f"{a}-{b}"
    if sign in "-‐‑" and "(" in first and ")" in second and a[0].islower() == b[0].islower():
        return m.known(whole), None
    if sign in "-‐‑":
        if shape(held) in m.count or b[0].isupper() and not a.isupper() or b[0].isdigit() or any(c.isdigit() for c in a):
            return False, None
        if m.known(whole):
            return True, None
        if a[0].islower() and m.known(a) and m.known(b) and len(a) > 2 and len(b) > 2 and not m.corrections(whole):
            return False, None
    if m.known(whole):
        return True, None
    for f in m.corrections(whole):
        same = next((k for k, (x, y) in enumerate(zip(whole, f)) if x != y), min(len(whole), len(f)))
        return True, 0 if same < len(a) else 1
    for k, piece in enumerate((a, b)):
        if any(c.isdigit() for c in piece) and not m.known(piece) and (mixed(piece) or m.corrections(piece)):
            return True, k
    return True, None


def scan_noise(words: DataFrame, pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``word_id, kind``: hyphen, misread, header, page_number; and ``fixed``, the text a misread word should have."""
    told = checkpoint(findings(words, learn(words) if model is None else model))
    junk = told.filter("what = 'count'").groupBy("page_id").agg(F.sum("known").alias("known"), F.sum("size").alias("size")).filter("known < 0.3 * size").select("page_id")
    page = first_delivery(pages.select("page_id", "scan_id", "page_idx", F.transform("layout", lambda r: F.struct(r["type"].alias("type"), edge(r["geometry"], 1, False).alias("y0"))).alias("regions"), "received_at"), "page_id", ["scan_id", "page_idx", "regions"], "received_at")
    page = page.select("page_id", F.coalesce("scan_id", -F.col("page_id")).alias("scan_id"), F.coalesce("page_idx", F.lit(1)).alias("page_idx"), "regions")
    key = F.lower(F.regexp_replace("line", r"[^\p{L}\p{N}]+", ""))
    lines = told.filter("what = 'line'").join(junk, "page_id", "left_anti").join(page, "page_id", "left").withColumn("key", key).withColumn("band", F.floor(F.col("y0") * 100))
    near = lambda r: F.abs(r["y0"] - F.col("y0")) < 0.02
    lines = lines.withColumn("type", F.get(F.filter("regions", near), F.lit(0))["type"]).drop("regions")
    repeated = lines.filter("key != ''").groupBy("scan_id", "key").agg(F.count(F.lit(1)).alias("times"))
    lines = checkpoint(lines.join(repeated, ["scan_id", "key"], "left"))
    # Where furniture stands: hundredths of the height whose blocks repeat in their scan or are page numbers.
    places = lines.groupBy("band").agg(F.avg(((F.coalesce("times", F.lit(1)) > 1) | ((F.col("line") == "") & (F.size("number_ids") > 0))).cast("int")).alias("rate")).filter((F.col("rate") >= FURNITURE) & F.col("band").isNotNull())
    placed = lines.join(F.broadcast(places), "band", "left").withColumn("furnished", F.col("rate").isNotNull())  # at most 100 rows
    bottom = placed.filter((F.col("furnished") & (F.col("y0") >= 0.5)) | (F.col("y0").isNull() & (F.col("block_idx") > 1)))
    top = placed.filter((F.col("furnished") & (F.col("y0") < 0.5)) | (F.col("y0").isNull() & (F.col("block_idx") == 0)))
    following = lines.filter("known = 1 and y0 < 0.5").select("page_id", (F.col("block_idx") - 1).alias("block_idx"), F.col("line").alias("next"))
    top = top.join(following, ["page_id", "block_idx"], "left")
    sentence, section = F.col("line").rlike(r"[.!?]\s*$"), F.col("line").rlike(r"^\s*\d+[.,]\d+\s|^\s*(?:[-–*•▪☐]|\(?\w{1,2}[.)])\s")
    again, numbered = F.coalesce("times", F.lit(1)) > 1, F.size("number_ids") > 0
    styled = F.col("line").rlike(r"\s[–-]\s|\d[./-]\d") | (F.upper("line") == F.col("line"))
    title_next = F.col("next").isNotNull() & ~F.col("next").rlike(r"[.!?]\s*$|^\s*\d+[.,]\d+\s|^\s*(?:[-–*•▪☐]|\(?\w{1,2}[.)])\s")
    first_page = numbered | styled | title_next | (F.col("type") == "Page-header") | (again & F.col("type").isNull())
    single = F.col("known") == 1
    running = F.when(F.col("line") == "", F.lit(True)).when(again & (F.col("page_idx") > 0), F.lit(True)).when(sentence | section | ~single, F.lit(False)).when(F.col("page_idx") > 0, F.lit(True)).otherwise(F.coalesce(first_page, F.lit(False)))
    furniture = top.filter(running).select("word_ids", "number_ids").union(bottom.select("word_ids", "number_ids"))
    outer = furniture.select(F.explode(F.transform("word_ids", lambda w: F.struct(w.alias("word_id"), F.when(F.array_contains("number_ids", w), "page_number").otherwise("header").alias("kind")))).alias("f")).select("f.word_id", "f.kind", F.lit(None).cast("string").alias("fixed"))
    inner = told.filter("what in ('hyphen', 'misread')").join(junk, "page_id", "left_anti").select(F.explode("word_ids").alias("word_id"), F.col("what").alias("kind"), F.when(F.col("what") == "misread", F.col("line")).alias("fixed"))
    return inner.join(outer.select("word_id"), "word_id", "left_anti").union(outer).groupBy("word_id", "kind").agg(F.max("fixed").alias("fixed"))


def paragraphs(words: DataFrame, pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, block_idx, text``: blocks without furniture, words corrected and joined, as running text."""
    noise = scan_noise(words, pages, model)
    flags = noise.groupBy(F.col("word_id").alias("_word")).agg(F.max((F.col("kind") == "hyphen").cast("int")).alias("joins"), F.max(F.col("kind").isin("header", "page_number").cast("int")).alias("drop"), F.max("fixed").alias("fixed"))
    kept = words.filter("page_id is not null and word_id is not null and value is not null").select("page_id", "block_idx", "line_idx", "word_idx", "word_id", "value").distinct()
    kept = kept.join(flags, kept.word_id == F.col("_word"), "left").filter("drop is null or drop = 0")
    text = F.trim(F.coalesce("fixed", "value"))
    piece = F.when(F.col("joins") == 1, F.regexp_replace(text, f"[{SIGNS}]$", "")).otherwise(F.concat(text, F.lit(" ")))
    blocks = kept.groupBy("page_id", "block_idx").agg(F.sort_array(F.collect_list(F.struct("line_idx", "word_idx", "word_id", piece.alias("piece")))).alias("w"))
    return blocks.select("page_id", "block_idx", F.rtrim(F.array_join(F.transform("w", lambda w: w["piece"]), "")).alias("text"))
