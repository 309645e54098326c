"""Problem 6: token ids of whole texts by a public byte-level BPE vocabulary.

The corpus block of a task is encoded at once.  Its texts are cut into chunks
(a run of non-blanks with at most one leading space, or a run of blanks); each
distinct chunk is encoded once.  New chunks are laid out as one array of byte
symbols, with the rank of the merge that starts at each position beside it.  The
merges are replayed in waves: a wave applies, in every word that still changes,
the merge of lowest rank at all its positions, which is the order of ranks within
each word, and then looks up anew only the merged positions and those before
them.  Documents then gather the ids of their chunks.  There is no shuffle, and
no row is looked at alone.

This departs from one global index that takes each pair to its positions and
applies one merge after the other: merges inside a word depend on that word
alone, so the ids are the same, while 50 000 steps over short lists of positions
would cost more than the waves, of which a word needs at most its length.  A
word that stands in the texts of several tasks is encoded once by each.

Defined results: a null or empty text has the empty list.  Every row of the
input gives one row, repeated rows and null ids included.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Blanks of the Unicode property White_Space.
BLANK = "\\t-\\r \x85\xa0  -     　"
CHUNK = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
#: Runs of blanks that a cut at each single space might divide wrongly.
RUN = f"[{BLANK}][{BLANK}] |  [{BLANK}]|[{BLANK}] [{BLANK}]|[{BLANK}] $|^ [{BLANK}]"
ODD = re.compile("[\x1c-\x1f]")
ASCII = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+")
#: The published split of the vocabulary's family (fixed value).
PRETOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 40
#: Distinct chunks kept by a task before its memory of them starts anew.
MOST_CHUNKS = 1_500_000


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return table


class Merges:
    """Byte ids and pair merges of a vocabulary file, in rank order."""

    def __init__(self, content: str):
        model = json.loads(content)["model"]
        ids = model["vocab"]
        self.byte_id = np.array([ids[s] for _, s in sorted(byte_symbols().items())], np.int64)
        rule: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            rule.setdefault(ids[left] << 20 | ids[right], (rank, ids[left + right]))
        self.key = np.array(sorted(rule), np.int64)
        self.rank, self.made = (np.array([rule[k][i] for k in self.key.tolist()], np.int64) for i in (0, 1))
        self.made_by_rank = np.zeros(len(model["merges"]), np.int64)
        self.made_by_rank[self.rank] = self.made

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NEVER where there is none."""
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (left >= 0) & (right >= 0), self.rank[at], NEVER)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the words.

        ``rank_at`` is the rank of the merge that starts at a position.  A wave applies to each word its lowest-ranked pair wherever it
        stands in the word, which is the order of ranks within every word; then
        only the merged positions and those before them are looked up anew.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        n = len(symbol)
        offset = np.concatenate([[0], np.cumsum(size)])
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        full = size > 0
        after[offset[1:][full] - 1] = n
        before[offset[:-1][full]] = n
        symbol = np.append(symbol, -1)  # place n: the end of every word
        after, before = np.append(after, n), np.append(before, n)
        rank_at = self.ranks(symbol, symbol[after])
        live, places = np.flatnonzero(size > 1), None
        chosen = np.zeros(n + 1, bool)
        while len(live):
            if places is None:  # positions of the words that still change, and where each word starts among them
                length = size[live]
                starts = np.concatenate([[0], np.cumsum(length)[:-1]])
                places = np.repeat(offset[live] - starts, length) + np.arange(length.sum())
            here = rank_at[places]
            lowest = np.minimum.reduceat(here, starts)
            go = lowest < NEVER
            p = places[(here == np.repeat(lowest, length)) & (here < NEVER)]
            if len(p):
                chosen[p] = True
                first = ~chosen[before[p]]
                chosen[p] = False
                if not first.all():  # a run of overlapping pairs: every second one, from the left
                    run = np.maximum.accumulate(np.where(first, np.arange(len(p)), 0))
                    p = p[(np.arange(len(p)) - run) % 2 == 0]
                q = after[p]
                symbol[p] = self.made_by_rank[rank_at[p]]
                symbol[q], rank_at[q] = -2, NEVER
                after[p] = after[q]
                before[after[p]] = p
                before[n] = n
                touched = np.concatenate([p, before[p]])
                touched = touched[touched < n]
                rank_at[touched] = self.ranks(symbol[touched], symbol[after[touched]])
            if go.sum() < 0.8 * len(go):
                live, places = live[go], None
        kept = symbol[:n] >= 0
        count = np.concatenate([[0], np.cumsum(kept)])
        return count[offset], symbol[:n][kept]


class Encoder:
    """Encodes blocks of texts; remembers the chunks it has seen."""

    def __init__(self, content: str):
        import regex

        self.merges = Merges(content)
        self.pretoken = regex.compile(PRETOKEN)
        self.forget()

    def forget(self) -> None:
        self.chunk: dict[str, int] = {}
        self.ids, self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def split(self, chunk: str) -> list[str]:
        bare = chunk[1:] if chunk[:1] == " " else chunk
        if bare.isalpha() or bare.isdecimal():
            return [chunk]
        return (ASCII if chunk.isascii() and not ODD.search(chunk) else self.pretoken).findall(chunk)

    def learn(self, chunks: list[str]) -> None:
        split = [self.split(c) for c in chunks]
        flat = [w for s in split for w in s]
        word = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        offset, ids = self.merges.replay([w.encode("utf-8", "replace") for w in word])
        at = np.fromiter(map(word.__getitem__, flat), np.int64, len(flat))
        length = np.diff(offset)[at]
        total = np.concatenate([[0], np.cumsum(length)])
        take = np.repeat(offset[at] - total[:-1], length) + np.arange(total[-1])
        ends = total[np.cumsum([len(s) for s in split])]
        starts = np.concatenate([[0], ends[:-1]])
        self.chunk.update(zip(chunks, range(len(self.start), len(self.start) + len(chunks))))
        self.start = np.concatenate([self.start, starts + len(self.ids)])
        self.length = np.concatenate([self.length, ends - starts])
        self.ids = np.concatenate([self.ids, ids[take].astype(np.int32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows in the order of the result, and offsets and ids as Arrow lists have them.

        Texts are cut at every single space, the space going with what follows.
        Where blanks run on so that such a cut could fall inside a token, the
        text is cut by CHUNK instead; these rows come last.
        """
        if len(self.chunk) > MOST_CHUNKS:
            self.forget()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, RUN).to_numpy(zero_copy_only=False)
        rows = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        pieces = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        ends = pieces.offsets.to_numpy().astype(np.int64)
        spaced = np.ones(ends[-1] - ends[0], np.int64)
        spaced[ends[:-1] - ends[0]] = 0
        ends = (ends - ends[0]).tolist()
        rest: list[str] = []
        for t in texts.filter(pa.array(odd)).to_pylist():
            rest.extend(CHUNK.findall(t))
            ends.append(len(spaced) + len(rest))
        coded = pa.concat_arrays([pieces.flatten(), pa.array(rest, texts.type)]).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64) * 2
        code[: len(spaced)] += spaced
        used = np.flatnonzero(np.bincount(code, minlength=2 * len(coded.dictionary)))
        names = coded.dictionary.to_pylist()
        names = [" " + names[c >> 1] if c & 1 else names[c >> 1] for c in used.tolist()]
        if new := [c for c in dict.fromkeys(names) if c not in self.chunk]:
            self.learn(new)
        at = np.zeros(2 * len(coded.dictionary), np.int64)
        at[used] = np.fromiter(map(self.chunk.__getitem__, names), np.int64, len(names))
        at = at[code]
        length = self.length[at]
        total = np.concatenate([[0], np.cumsum(length)])
        take = np.repeat(self.start[at] - total[:-1], length)
        take += np.arange(total[-1])
        return rows, total[ends].astype(np.int32), self.ids[take]


def token_ids(documents: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each whole text, without special tokens."""
    with open(vocabulary, encoding="utf-8") as f:
        content = documents.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: 1.5 MB, whatever the data
    key = documents.schema[id_column].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(content.value)
        for b in batches:
            texts = b.column(1)
            step = max(1, min(len(texts), int(len(texts) * 8e6 / max(1, texts.nbytes))))  # about 8 MB of text at once
            for s in range(0, len(texts), step):
                rows, offsets, ids = encoder.encode(texts.slice(s, step))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, step).take(pa.array(rows)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    kept = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return kept.mapInArrow(run, f"doc_id {key.simpleString()}, ids array<int>")
