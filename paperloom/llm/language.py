"""Problem 2: the language of pages and of blocks in another language.

Scripts narrow the candidates: Cyrillic and Greek words have one language here,
Latin ones seven.  Words are scored by how often they stand on pages of each
language, learnt over the whole corpus from the labels the pages came with; the
labels are noisy, but the words outvote them, and a second round, which counts
every word under the language that the first one decoded it as, cleans them, even
where a whole feed has a wrong label.  Words the model does not know, as invented names,
references and numbers, score nothing.  Viterbi with a penalty for every switch
labels the words of a block; blocks are decoded side by side.  Its path gives
spans of one language, joined over the chunks of a block.  The counts of
words by language are summed to blocks and pages; the page's main language is
that of most of its words.

Defined results: null and unknown words have no language; a page or block with
too little evidence has a null language and confidence 0, and is no case; the
notation of a label (case, three letters, region, English name) does not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dedup import first_delivery
from ..session import checkpoint
from .lookalike import MEMBERS, script_of
from .pagestream import Lookup, chunk_words, starts, word_tables
from .quality import WORD, bare

#: Codes, three-letter codes and English names of the languages (fixed values).
NAMES = {
    "en": "eng english", "fr": "fra fre french", "de": "deu ger german", "es": "spa spanish castilian", "it": "ita italian",
    "nl": "nld dut dutch flemish", "pt": "por portuguese", "ru": "rus russian", "el": "ell gre greek",
}
LANGUAGES = list(NAMES)
SCRIPT = {"ru": "C", "el": "G"}
#: Cost of a switch, in nats; the score of a word is kept within this.
SWITCH, MOST = 8.0, 4.0
SCHEMA = ", ".join(f"n_{x} long" for x in LANGUAGES)


def language_code(label: Column) -> Column:
    """Two-letter code of a label in any notation; null if it names no language."""
    plain = F.element_at(F.split(F.lower(F.trim(label)), "[-_ ]"), 1)
    pairs = [(a, k) for k, names in NAMES.items() for a in (k, *names.split())]
    return F.create_map(*(F.lit(x) for p in pairs for x in p))[plain]


def _letters(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, r"[^\p{L}\p{M}]+", ""))


def word_scores(words: DataFrame, languages: DataFrame, share: float = 0.002) -> dict[str, np.ndarray]:
    """Log-likelihood of frequent words by language, against the mean of the candidates.

    ``languages``: ``page_id, lang``.
    """
    tokens = words.filter("value is not null").select("page_id", _letters(F.col("value")).alias("w")).filter("length(w) > 0")
    pages = {r.lang: r["count"] for r in languages.groupBy("lang").count().collect()}
    return _scores(tokens.join(languages, "page_id").groupBy("w", "lang").agg(F.count(F.lit(1)).alias("n")), pages, share)


def _scores(counts: DataFrame, pages: dict[str, float], share: float) -> dict[str, np.ndarray]:
    """Scores from ``w, lang, n``.

    Kept are words with ``share`` occurrences a page of a language, some ten
    thousand for each language at most, whatever the corpus.
    """
    frequent = [F.col(x) >= max(3, share * pages.get(x, 0)) for x in LANGUAGES]
    keep = frequent[0]
    for f in frequent[1:]:
        keep = keep | f
    rows = counts.groupBy("w").pivot("lang", LANGUAGES).agg(F.sum("n")).na.fill(0).filter(keep).collect()
    if not rows:
        return {}
    names: dict[str, np.ndarray] = {}
    for r in rows:
        name = bare(r.w) or r.w
        if name in ("i", "l") or (len(name) > 1 and len(set(name)) == 1):
            continue  # as bars are read
        names[name] = names.get(name, 0) + np.array([r[x] for x in LANGUAGES], float)
    count = np.array(list(names.values()))
    total = count.sum(axis=0) + 1
    rate = (count + 0.5 * total / total.sum()) / total
    rate += 0.02 * rate.mean(axis=1, keepdims=True)  # what wrong labels leave
    out = {}
    for name, p in zip(names, np.log(rate)):
        scripts = {s for c in name if c not in MEMBERS and (s := script_of(c))}  # letters of one script only
        if len(scripts) > 1:
            continue
        fits = np.array([not scripts or SCRIPT.get(x, "L") in scripts for x in LANGUAGES])
        score = np.where(fits, p - p[fits].max(), -MOST)
        score = np.maximum(score, -MOST)
        out[name] = (score - score.mean()).astype(np.float32)
    return out


def viterbi(score: np.ndarray, start: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word; sequences begin at ``start`` and are decoded side by side."""
    n = len(score)
    length = np.diff(np.append(start, n))
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    back = np.zeros((n, score.shape[1]), np.int8)
    best = score[start].copy()
    alive = len(start)
    final = np.zeros(len(start), np.int64)
    for t in range(1, int(length.max(initial=0)) + 1):
        going = int(np.searchsorted(-length, -t, side="left"))  # sequences longer than t
        final[going:alive] = best[going:alive].argmax(axis=1)
        alive = going
        if not alive:
            break
        top = best[:alive].argmax(axis=1)
        high = best[np.arange(alive), top] - switch
        stay = best[:alive] >= high[:, None]
        back[start[:alive] + t] = np.where(stay, np.arange(score.shape[1]), top[:, None])
        best = np.where(stay, best[:alive], high[:, None]) + score[start[:alive] + t]
    label = np.zeros(n, np.int64)
    label[start + length - 1] = final
    for t in range(int(length.max(initial=1)) - 1, 0, -1):
        s = start[: int(np.searchsorted(-length, -t, side="left"))]
        label[s + t - 1] = back[s + t, label[s + t]]
    return label


def decoded_words(chunks: DataFrame, scores: dict[str, np.ndarray], what: str) -> DataFrame:
    """The Viterbi path over the words of each chunk, told in one of three ways.

    ``words``: ``w, lang, n``, each word by the language it was decoded as;
    ``counts``: words by language and ``lead``, the evidence of each language in
    nats, of chunks; ``spans``: stretches of one language, from the first to the
    last word.
    """
    shared = chunks.sparkSession.sparkContext.broadcast(scores)
    key = chunks.schema["page_id"].dataType.simpleString()

    def lookup(values: list[str]) -> np.ndarray:
        known, nothing = shared.value, np.zeros(len(LANGUAGES), np.float32)
        made = np.zeros((len(values), len(LANGUAGES) + 1), np.float32)  # the last: how far it should be known
        for i, v in enumerate(values):
            made[i, :-1] = known.get(bare(v) or v.lower(), nothing)
            made[i, -1] = 1.0 if WORD.search(v) else 0.3
        return made

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        look_up = Lookup(lookup)
        for t in word_tables(batches):
            traits = look_up(t.column("value"))
            at = np.flatnonzero(starts(*(t.column(c).to_numpy() for c in ("page_id", "block_idx", "chunk", "part"))))
            score = traits[:, :-1]
            yield t, traits, at, viterbi(score, at), np.abs(score).sum(axis=1) > 0

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        spell = Lookup(lambda vs: np.array([bare(v) or v.lower() if WORD.search(v) or v.isalpha() else "" for v in vs], object))

        def out() -> pa.RecordBatch:
            w, n = list(total), np.array(list(total.values())).reshape(-1, len(LANGUAGES))
            i, j = np.nonzero(n)
            return pa.RecordBatch.from_arrays([pa.array([w[k] for k in i], pa.string()), pa.array([LANGUAGES[k] for k in j], pa.string()), pa.array(n[i, j].astype(np.int64))], ["w", "lang", "n"])

        for t, _, at, label, known in decode(batches):
            size = np.diff(np.append(at, len(label)))
            sure = np.add.reduceat(known, at)
            heard = np.repeat((sure * 3 >= size) & (sure >= 8), size)  # a chunk with few known words says nothing
            for w, x in zip(spell(t.column("value"))[heard].tolist(), label[heard].tolist()):
                if w:
                    if (n := total.get(w)) is None:
                        n = total[w] = np.zeros(len(LANGUAGES), np.int64)
                    n[x] += 1
            if len(total) > 200_000:
                yield out()
                total.clear()
        yield out()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, traits, at, label, known in decode(batches):
            n = np.zeros((len(label), len(LANGUAGES)), np.int64)
            n[np.flatnonzero(known), label[known]] = 1
            sums, lead = np.add.reduceat(n, at), np.add.reduceat(traits[:, :-1].astype(np.float64), at)
            size = np.add.reduceat(traits[:, -1].astype(np.float64), at)
            arrays = [*(t.column(c).combine_chunks().take(pa.array(at)) for c in ("page_id", "block_idx")), pa.array(size), *map(pa.array, sums.T), *map(pa.array, lead.T)]
            yield pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], ["page_id", "block_idx", "n_words", *(f"n_{x}" for x in LANGUAGES), *(f"lead_{x}" for x in LANGUAGES)])

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, traits, at, label, known in decode(batches):
            mark = np.zeros(len(label), bool)
            mark[at] = True
            first = np.flatnonzero(starts(label) | mark)
            last = np.append(first[1:], len(label)) - 1
            own = known & (traits[np.arange(len(label)), label] >= traits[:, :-1].max(axis=1) - 1e-6)
            take = lambda c, i: t.column(c).combine_chunks().take(pa.array(i))
            arrays = [take("page_id", first), take("block_idx", first), *(take(c, i) for i in (first, last) for c in ("line_idx", "word_idx", "word_id")), pa.array([LANGUAGES[k] for k in label[first]]), pa.array(last - first + 1), *(pa.array(np.add.reduceat(x.astype(np.int64), first)) for x in (known, own))]
            yield pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], SPAN)

    word = chunks.schema["words"].dataType.elementType["word_id"].dataType.simpleString()
    if what == "words":
        return chunks.mapInArrow(tally, "w string, lang string, n long")
    if what == "counts":
        return chunks.mapInArrow(count, f"page_id {key}, block_idx int, n_words double, {SCHEMA}, " + ", ".join(f"lead_{x} double" for x in LANGUAGES))
    ends = ", ".join(f"{e}_line int, {e}_word int, {e}_id {word}" for e in ("first", "last"))
    return chunks.mapInArrow(span, f"page_id {key}, block_idx int, {ends}, lang string, n_words long, n_known long, n_own long")


SPAN = ["page_id", "block_idx", "first_line", "first_word", "first_id", "last_line", "last_word", "last_id", "lang", "n_words", "n_known", "n_own"]


def block_languages(chunks: DataFrame, scores: dict[str, np.ndarray]) -> DataFrame:
    """``page_id, block_idx``, words by language and ``lead``: evidence of each language, in nats."""
    parts = decoded_words(chunks, scores, "counts")
    return parts.groupBy("page_id", "block_idx").agg(*(F.sum(c).alias(c) for c in parts.columns[2:]))


def language_spans(words: DataFrame, pages: DataFrame) -> DataFrame:
    """Stretches of one language in each block: first and last word, language and confidence.

    Neighbouring stretches of one language, of one chunk or the next, are one.
    The confidence is the share of the known words that speak for the language
    themselves; stretches without a known word have none and no language.
    """
    chunks, scores, _ = trained(words, pages)
    spans = decoded_words(chunks, scores, "spans")
    order = Window.partitionBy("page_id", "block_idx").orderBy("first_line", "first_word", "first_id")
    spans = spans.withColumn("lang", F.when(F.col("n_known") > 0, F.col("lang")))
    spans = spans.withColumn("span_idx", F.sum((~F.lag("lang", 1, "").over(order).eqNullSafe(F.col("lang"))).cast("int")).over(order))
    at = lambda e: F.struct(f"{e}_line", f"{e}_word", f"{e}_id")
    out = spans.groupBy("page_id", "block_idx", "span_idx", "lang").agg(F.min(at("first")).alias("a"), F.max(at("last")).alias("b"), *(F.sum(c).alias(c) for c in ("n_words", "n_known", "n_own")))
    return out.select("page_id", "block_idx", F.col("span_idx").cast("int").alias("span_idx"), F.col("a.first_id").alias("first_word_id"), F.col("b.last_id").alias("last_word_id"), "n_words", "lang", F.round(F.coalesce(F.try_divide("n_own", "n_known"), F.lit(0.0)), 4).alias("confidence"))


def _best(prefix: str) -> Column:
    """The language with the greatest column; ties go to the earlier language."""
    top = F.greatest(*(F.col(f"{prefix}_{x}") for x in LANGUAGES))
    return F.coalesce(*(F.when(F.col(f"{prefix}_{x}") == top, F.lit(x)) for x in LANGUAGES))


def _judged(df: DataFrame, least_words: int, least_share: float) -> DataFrame:
    """Adds ``lang`` and ``confidence`` from the counts."""
    known = sum(F.col(f"n_{x}") for x in LANGUAGES)
    top = F.greatest(*(F.col(f"n_{x}") for x in LANGUAGES))
    enough = (known >= least_words) & (known >= least_share * F.col("n_words"))
    return df.withColumn("lang", F.when(enough, _best("n"))).withColumn("confidence", F.when(enough, F.round(top / known, 4)).otherwise(0.0))


def trained(words: DataFrame, pages: DataFrame, share: float = 0.002) -> tuple[DataFrame, dict[str, np.ndarray], DataFrame]:
    """Chunks of words, scores after two rounds, and the pages' labels."""
    labels = first_delivery(pages.select("page_id", F.col("language.value").alias("value"), "received_at"), "page_id", ["value"], "received_at")
    labels = labels.select("page_id", language_code(F.col("value")).alias("label"))
    named = labels.filter("label is not null").select("page_id", F.col("label").alias("lang"))
    chunks = checkpoint(chunk_words(words.filter("value is not null"), value=F.col("value")))  # read by both rounds
    first = word_scores(words, named, share)
    counts = checkpoint(decoded_words(chunks, first, "words").groupBy("w", "lang").agg(F.sum("n").alias("n")))
    heard = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    total = labels.count() / max(1, sum(heard.values()))
    return chunks, _scores(counts, {k: n * total for k, n in heard.items()}, share) or first, labels


def detect_languages(words: DataFrame, pages: DataFrame, margin: float = 6.0) -> tuple[DataFrame, DataFrame]:
    """Pages (``page_id, label, lang, confidence``) and blocks (``page_id, block_idx, lang, confidence, main``).

    ``margin``: evidence, in nats, by which a block's language must be ahead of
    the page's main one.
    """
    chunks, scores, labels = trained(words, pages)
    blocks = checkpoint(block_languages(chunks, scores))  # a few numbers a block, read twice
    counts = blocks.groupBy("page_id").agg(*(F.sum(c).alias(c) for c in ["n_words", *(f"n_{x}" for x in LANGUAGES)]))
    main = _judged(counts, 3, 0.3).select("page_id", "lang", "confidence")
    out = labels.join(main, "page_id").select("page_id", "label", "lang", "confidence")
    against = sum(F.when(F.col("main") == x, F.col(f"lead_{x}")).otherwise(0.0) for x in LANGUAGES)
    ahead = F.greatest(*(F.col(f"lead_{x}") for x in LANGUAGES)) - against
    own = _judged(blocks, 2, 0.2).join(main.select("page_id", F.col("lang").alias("main")), "page_id")
    own = own.withColumn("lang", F.when(F.col("lang").isNotNull() & F.col("main").isNotNull() & (ahead < margin), F.col("main")).otherwise(F.col("lang")))
    return out, own.select("page_id", "block_idx", "lang", "confidence", "main")


def language_cases(words: DataFrame, pages: DataFrame) -> DataFrame:
    """``page_id, block_idx, lang``: wrong or missing labels (block -1) and blocks in another language.

    Junk pages, few of whose words the model knows, have no language and are no cases.
    """
    page, block = detect_languages(words, pages)
    wrong = page.filter("lang is not null and not (label <=> lang)").select("page_id", F.lit(-1).alias("block_idx"), "lang")
    other = block.filter("lang is not null and main is not null and lang != main").select("page_id", "block_idx", "lang")
    return wrong.union(other)
