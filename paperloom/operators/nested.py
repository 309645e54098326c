"""Problem 4: flat, linked rows of deeply nested recognition exports.

A block of payloads is read as one byte array.  A table look-up gives the
bitmaps of quotes, brackets and delimiters; quote parity takes out what lies in
strings; a prefix sum over the brackets that remain is the nesting depth.  From
the depths come, without looking at single payloads, the parent of every
container (the last one opened a level above), its position (commas of its
parent before it) and its key (the string before its colon).  The same index
tells which payloads are readable in full: brackets must pair, every token must
be one that may follow the token before it, and scalars, escapes and characters
must be valid.  Objects of layout, tables, cells, items, blocks, lines and words
are then linked level by level.

A payload may be wrapped: a byte order mark, lists and objects around the
OCROut, JSON strings that hold JSON, to any depth.  Only payloads that hold no
OCROut as they stand are looked at one by one, for strings that hold JSON.

Defined results: null, empty, cut or otherwise unreadable payloads and those
without any of items, layout and tables give no rows.  Nesting has no limit.
If several objects could be the
OCROut, the outermost and then the first one is it.  A null element is no object
but keeps its position; an object where an array belongs has position 0; of a
repeated key the last value counts; keys are compared whole, escapes decoded.
Repeated deliveries count once, the earliest being read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_delivery

#: Kind, its key, and the kind of the object that holds it ("" for the OCROut).
KINDS = [("layout", ""), ("tables", ""), ("cells", "tables"), ("items", ""), ("blocks", "items"), ("lines", "blocks"), ("words", "lines")]
FIELDS = ["value", "type", "confidence", "objectness_score", "geometry", "crop_orientation", "num_rows", "num_cols", "row_start", "row_end", "col_start", "col_end"]
#: Bytes of payload looked at together.
BLOCK = 4_000_000
MARKS = "\ufeff \t\r\n"

_CLASS = np.zeros(256, np.uint8)
for _i, _c in enumerate(b'{[}],:"', 1):
    _CLASS[_c] = _i
OPEN_OBJECT, OPEN_ARRAY, CLOSE_OBJECT, CLOSE_ARRAY, COMMA, COLON, QUOTE, SCALAR = range(1, 9)
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n")] = True
_ESCAPED, _HEX = np.zeros(256, bool), np.zeros(256, bool)
_ESCAPED[list(b'"\\/bfnrtu')] = True
_HEX[list(b"0123456789abcdefABCDEF")] = True
_SCALARS = r"^(?:-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null|NaN|-?Infinity)$"


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of stretches laid end to end."""
    offsets = np.concatenate([[0], np.cumsum(size)])
    return offsets, data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]


def _name(name: bytes) -> tuple[np.uint64, np.uint64, int]:
    low, high = (np.uint64(int.from_bytes(name[i : i + 8].ljust(8, b"\0"), "little")) for i in (0, 8))
    return low, high, len(name)


class Index:
    """Containers of a block of JSON texts, with parent, position and key; and which texts are valid."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts) + b"\n" * 32, np.uint8)
        self.data, n = data, len(texts)
        size = np.fromiter(map(len, texts), np.int64, n)
        self.begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        self.finish = self.begin + size
        kind = _CLASS[data]
        marks = np.flatnonzero(kind)
        quotes = self._quotes(data, marks[kind[marks] == QUOTE])
        text_of = lambda at: np.searchsorted(self.begin, at, side="right") - 1
        # Quotes pair inside their text; a text with an odd number is cut.
        of = text_of(quotes)
        first = np.searchsorted(quotes, self.begin)
        number = np.diff(np.append(first, len(quotes)))
        self.valid = number % 2 == 0
        rank = np.arange(len(quotes)) - first[of]
        last = rank == number[of] - 1
        opening = (rank % 2 == 0) & ~(last & (number[of] % 2 == 1))
        self.string, self.string_end = quotes[opening], quotes[rank % 2 == 1]
        # Bytes inside strings.
        inside = np.zeros(len(data) + 1, np.int8)
        inside[self.string] = 1
        inside[self.string_end + 1] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        plain = marks[(kind[marks] < QUOTE) & ~inside[marks]]
        other = ~(inside | _BLANK[data] | (kind > 0))
        edge = np.flatnonzero(other[1:] != other[:-1]) + 1
        edge = np.concatenate([[0], edge]) if other[0] else edge
        scalar, scalar_end = edge[::2], edge[1::2]
        at = np.concatenate([plain, self.string, scalar])
        token = np.concatenate([kind[plain], np.full(len(self.string), QUOTE, np.uint8), np.full(len(scalar), SCALAR, np.uint8)])
        order = np.argsort(at, kind="stable")
        at, token = at[order], token[order]
        text = text_of(at)
        opens, closes = token <= OPEN_ARRAY, (token == CLOSE_OBJECT) | (token == CLOSE_ARRAY)
        depth = np.cumsum(opens.astype(np.int64) - closes)
        start = np.searchsorted(text, np.arange(n + 1))
        before = np.where(start[:-1] > 0, depth[np.maximum(start[:-1] - 1, 0)], 0) if len(depth) else np.zeros(n, np.int64)
        depth = depth - before[text]  # an open bracket has the depth of what it holds
        self.at, self.kind, self.depth, self.text_at = at, token, depth, text
        self._check(scalar, scalar_end, start, opens, closes, inside)
        good = self.valid[text]
        self.events = np.int64(len(at) + 1)
        #: Events that open something; the rest of the arrays goes by these.
        self.open = np.flatnonzero(opens & good)
        self.level, self.is_object, self.text = depth[self.open], token[self.open] == OPEN_OBJECT, text[self.open]
        self.close = np.flatnonzero(closes & good)
        self._by_level = np.argsort(self.level, kind="stable")
        self._level_key = (self.level * self.events + self.open)[self._by_level]
        self.parent = np.where(self.level > 1, self.holder(self.level - 1, self.open), -1)
        commas = np.flatnonzero((token == COMMA) & good)
        comma_key = np.sort(depth[commas] * self.events + commas)
        counted = lambda level, event: np.searchsorted(comma_key, level * self.events + event)
        self.position = np.where(self.parent >= 0, counted(self.level - 1, self.open) - counted(self.level - 1, self.open[self.parent]), 0)
        has_key = (self.open > 0) & (token[np.maximum(self.open - 1, 0)] == COLON)
        self.key = tuple(np.zeros(len(self.open), t) for t in (np.uint64, np.uint64, np.int64))
        for whole, part in zip(self.key, self._keys(at[self.open[has_key] - 1])):
            whole[has_key] = part

    def holder(self, level: np.ndarray, event: np.ndarray) -> np.ndarray:
        """The last container opened at a level before an event."""
        place = np.searchsorted(self._level_key, level * self.events + event) - 1
        return self._by_level[np.maximum(place, 0)] if len(self._by_level) else np.zeros(len(event), np.int64)

    def _check(self, scalar: np.ndarray, scalar_end: np.ndarray, start: np.ndarray, opens: np.ndarray, closes: np.ndarray, inside: np.ndarray) -> None:
        """Takes out the texts that are no JSON in full."""
        kind, depth, text, n = self.kind, self.depth, self.text_at, len(self.valid)
        bad = lambda where: self.valid.__setitem__(where, False)
        bad(np.diff(start) == 0)
        if not len(kind):
            return
        final = np.maximum(start[1:] - 1, 0)
        bad(depth[final] != 0)
        bad(text[depth < 0])
        # Brackets pair: at every depth opening and closing ones alternate, of one type.
        brackets = np.flatnonzero(opens | closes)
        level = depth[brackets] + closes[brackets]
        order = np.lexsort((brackets, level, text[brackets]))
        b, lv = brackets[order], level[order]
        second = np.flatnonzero(closes[b])
        fits = (second > 0) & (kind[b[second - 1]] + 2 == kind[b[second]]) & (lv[second - 1] == lv[second]) & (text[b[second - 1]] == text[b[second]])
        bad(text[b[second[~fits]]])
        # What holds each token: found by the same order, with the depth it lies at.
        held = depth - opens + closes  # depth outside a container for its brackets
        opened = np.flatnonzero(opens)
        by = np.argsort(depth[opened] + text[opened] * 0, kind="stable")
        many = np.int64(len(kind) + 1)
        keys = (depth[opened] * many + opened)[by]
        place = np.searchsorted(keys, np.maximum(held, 0) * many + np.arange(len(kind))) - 1
        owner = opened[by[np.maximum(place, 0)]] if len(opened) else np.zeros(len(kind), np.int64)
        in_object = (held > 0) & (kind[owner] == OPEN_OBJECT)
        before = np.concatenate([[0], kind[:-1]])
        before[start[:-1][start[:-1] < len(kind)]] = 0
        begins = opens | (kind == QUOTE) | (kind == SCALAR)
        is_key = (kind == QUOTE) & in_object & ((before == OPEN_OBJECT) | (before == COMMA))
        after_key = np.concatenate([[False], is_key[:-1]]) & (before > 0)
        ended = ((before == QUOTE) & ~after_key) | (before == SCALAR) | (before == CLOSE_OBJECT) | (before == CLOSE_ARRAY)
        may = np.where(before == 0, begins, False)
        may |= (before == OPEN_OBJECT) & (is_key | (kind == CLOSE_OBJECT))
        may |= (before == OPEN_ARRAY) & (begins | (kind == CLOSE_ARRAY))
        may |= (before == COMMA) & np.where(in_object, is_key, begins)
        may |= (before == COLON) & begins
        may |= after_key & (kind == COLON)
        may |= ended & (held > 0) & ((kind == COMMA) | (closes & ((kind == CLOSE_OBJECT) == in_object)))
        may &= ~((kind == COLON) & ~after_key)
        bad(text[~may])
        offsets, body = _slices(self.data, scalar, scalar_end - scalar)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(scalar), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())])
        fine = pc.match_substring_regex(words, _SCALARS).to_numpy(zero_copy_only=False).astype(bool)
        bad(np.searchsorted(self.begin, scalar[~fine], side="right") - 1)
        where = lambda at: np.searchsorted(self.begin, at, side="right") - 1
        bad(where(np.flatnonzero(inside & (self.data < 32))))
        slash = np.flatnonzero(inside & (self.data == 92))
        if len(slash):  # of a run of backslashes every second one is escaped itself
            fresh = np.concatenate([[True], np.diff(slash) > 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(slash)), 0))
            slash = slash[(np.arange(len(slash)) - run) % 2 == 0]
            bad(where(slash[~_ESCAPED[self.data[slash + 1]]]))
            code = slash[self.data[slash + 1] == ord("u")]
            bad(where(code[~np.all([_HEX[self.data[code + k]] for k in range(2, 6)], axis=0)] if len(code) else code))

    @staticmethod
    def _quotes(data: np.ndarray, quotes: np.ndarray) -> np.ndarray:
        """Quotes that an even number of backslashes precedes."""
        odd = np.zeros(len(quotes), bool)
        back = np.flatnonzero(data[quotes - 1] == 92) if len(quotes) else quotes
        back = back[quotes[back] > 0]
        if len(back):  # lengths of the runs of backslashes
            slash = np.flatnonzero(data == 92)
            fresh = np.concatenate([[True], np.diff(slash) > 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(slash)), 0))
            k = np.searchsorted(slash, quotes[back] - 1)
            odd[back] = (k - run[k] + 1) % 2 == 1
        return quotes[~odd]

    def _keys(self, colon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First sixteen bytes and length of the decoded string before each colon."""
        k = np.maximum(np.searchsorted(self.string, colon) - 1, 0)
        if not len(colon):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        start, end = self.string[k] + 1, self.string_end[k]
        words = []
        for low in (0, 8):
            bits = np.zeros(len(colon), np.uint64)
            for i in range(low, low + 8):
                byte = np.where(start + i < end, self.data[np.minimum(start + i, len(self.data) - 1)], 0)
                bits |= byte.astype(np.uint64) << np.uint64(8 * (i - low))
            words.append(bits)
        length = end - start
        if not hasattr(self, "_slashes"):
            self._slashes = np.flatnonzero(self.data == 92)
        for j in np.flatnonzero(np.searchsorted(self._slashes, end) > np.searchsorted(self._slashes, start)):
            name = json.loads(b'"' + self.data[start[j] : end[j]].tobytes() + b'"').encode("utf-8", "surrogatepass")
            words[0][j], words[1][j], length[j] = _name(name)
        return words[0], words[1], length

    def named(self, name: str) -> np.ndarray:
        low, high, length = _name(name.encode())
        return (self.key[0] == low) & (self.key[1] == high) & (self.key[2] == length)

    def fields(self) -> dict[str, np.ndarray]:
        """Containers that are a member of an object under the name of a kind; of a repeated key the last."""
        under = (self.parent >= 0) & self.is_object[self.parent]
        out = {}
        for kind, _ in KINDS:
            mine = np.flatnonzero(under & self.named(kind))
            order = np.lexsort((mine, self.parent[mine]))
            mine = mine[order]
            last = np.append(self.parent[mine][1:] != self.parent[mine][:-1], True)[: len(mine)]
            out[kind] = np.zeros(len(self.open), bool)
            out[kind][mine[last]] = True
        return out

    def objects(self) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each kind: the objects, their holders and their positions."""
        child, fields = self.parent >= 0, self.fields()
        top = np.flatnonzero(fields["layout"] | fields["tables"] | fields["items"])
        found: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        held = {"": np.zeros(len(self.open) + 1, bool)}
        if len(top):
            best = np.lexsort((top, self.level[top], self.text[top]))
            one = top[best[np.concatenate([[True], np.diff(self.text[top[best]]) > 0])]]
            held[""][self.parent[one]] = True
        for kind, holder in KINDS:
            field = np.append(fields[kind] & held[holder][self.parent], False)
            inside = self.is_object & child & field[self.parent] & ~self.is_object[self.parent]
            single = field[:-1] & self.is_object
            objects = np.flatnonzero(inside | single)
            holders = np.where(single[objects], self.parent[objects], self.parent[self.parent[objects]])
            found[kind] = objects, holders, np.where(single[objects], 0, self.position[objects])
            held[kind] = np.zeros(len(self.open) + 1, bool)
            held[kind][objects] = True
        return found

    def values(self, objects: np.ndarray, name: str) -> pa.Array:
        """JSON text of the member ``name`` of each object, null where absent."""
        if not hasattr(self, "_members"):
            colons = np.flatnonzero((self.kind == COLON) & self.valid[self.text_at])
            self._members = colons, self._keys(self.at[colons]), self.holder(self.depth[colons], colons)
        colons, keys, owner = self._members
        low, high, size = _name(name.encode())
        mine = np.flatnonzero((keys[0] == low) & (keys[1] == high) & (keys[2] == size))
        slot = np.full(len(self.open), -1)
        slot[owner[mine]] = mine
        colon = slot[objects]
        have = colon >= 0
        c = colons[colon[have]]
        after = c + 1
        start = self.at[c] + 1
        follows = np.where(self.kind[after] <= OPEN_ARRAY, 0, after + 1)
        nested = self.kind[after] <= OPEN_ARRAY  # a container: up to where its depth is left
        end = self.at[np.minimum(follows, len(self.at) - 1)]
        if nested.any():
            end[nested] = self.at[self._leave(after[nested], self.depth[c[nested]])] + 1
        sizes = np.zeros(len(objects), np.int64)
        sizes[have] = end - start
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        body = _slices(self.data, start, end - start)[1]
        return pa.LargeStringArray.from_buffers(len(objects), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes()), pa.py_buffer(np.packbits(have, bitorder="little").tobytes())).cast(pa.string())

    def _leave(self, opened: np.ndarray, base: np.ndarray) -> np.ndarray:
        """The bracket that closes what opens at each event."""
        order = np.argsort(self.depth[self.close], kind="stable")
        keys = (self.depth[self.close] * self.events + self.close)[order]
        return self.close[order[np.searchsorted(keys, base * self.events + opened)]]


def unwrapped(payload: str | None) -> str | None:
    """The JSON text of an OCROut or around it, out of marks and string wrappers; None if there is none or it is unreadable."""
    if payload is None:
        return None
    text = payload.lstrip(MARKS)
    index = Index([text.encode("utf-8", "surrogatepass")])
    if not index.valid[0]:
        return None
    fields = index.fields()
    if any(fields[k].any() for k, holder in KINDS if not holder):
        return text
    # Text inside a wrapper, the outermost first; keys are not looked at.
    at = np.flatnonzero(index.kind == QUOTE)
    at = at[np.append(index.kind, 0)[at + 1] != COLON]
    for i in at[np.argsort(index.depth[at], kind="stable")].tolist():
        k = np.searchsorted(index.string, index.at[i])
        inner = json.loads(index.data[index.string[k] : index.string_end[k] + 1].tobytes())
        if inner.lstrip(MARKS)[:1] in ("{", "[", '"') and (found := unwrapped(inner)) is not None:
            return found
    return None


def _rows(ids: pa.Array, texts: list[str], values: bool) -> Iterator[pa.RecordBatch]:
    index = Index([t.encode("utf-8", "surrogatepass") for t in texts])
    fields = index.fields()
    plain = np.zeros(len(texts), bool)
    for kind, holder in KINDS:
        if not holder:
            plain[index.text[fields[kind]]] = True
    # What holds no OCROut as it stands is unreadable, or has JSON inside a string.
    inner = {i: t for i in np.flatnonzero(index.valid & ~plain).tolist() if (t := unwrapped(texts[i])) is not None}
    if inner:
        yield from _rows(ids.take(pa.array(list(inner))), list(inner.values()), values)
    paths: dict[str, tuple[np.ndarray, pa.Array]] = {}
    found = index.objects()
    for kind, holder in KINDS:
        objects, holders, positions = found[kind]
        if not len(objects):
            paths[kind] = objects, pa.array([], pa.string())
            continue
        number = pa.array(positions).cast(pa.string())
        if holder:
            known, names = paths[holder]
            up = names.take(pa.array(np.searchsorted(known, holders)))
            path = pc.binary_join_element_wise(up, kind, number, "/")
        else:
            up = pa.array([""]).take(pa.array(np.zeros(len(objects), np.int64)))
            path = pc.binary_join_element_wise(kind, number, "/")
        paths[kind] = objects, path
        columns = [ids.take(pa.array(index.text[objects])), pa.array([kind]).take(pa.array(np.zeros(len(objects), np.int64))), path, up, pa.array(positions.astype(np.int32))]
        names_ = ["export_id", "kind", "path", "parent_path", "position"]
        if values:
            columns += [index.values(objects, f) for f in FIELDS]
            names_ += FIELDS
        yield pa.RecordBatch.from_arrays(columns, names_)


def export_objects(exports: DataFrame, key: str = "export_id", payload: str = "payload", received: str = "received_at", values: bool = True) -> DataFrame:
    """A row for every object: ``export_id, kind, path, parent_path, position``.

    With ``values`` the object's own members follow as JSON text, null where the
    payload has none; ``typed_objects`` turns them into numbers and geometry.
    """
    kept = exports.select(F.col(key).alias("export_id"), F.col(payload).cast("string").alias("payload"), F.col(received).alias("received_at")).filter("payload is not null and export_id is not null")
    kept = first_delivery(kept, "export_id", ["payload"], "received_at")
    key_type = exports.schema[key].dataType.simpleString()
    schema = f"export_id {key_type}, kind string, path string, parent_path string, position int" + "".join(f", {f} string" for f in FIELDS if values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[int] = []
        texts: list[str] = []
        for b in batches:
            held, payloads = 0, b.column(1).to_pylist()
            rows, texts = [], []
            for i in range(b.num_rows):
                rows.append(i)
                texts.append(payloads[i].lstrip(MARKS))
                held += len(texts[-1])
                if texts and (held >= BLOCK or i == b.num_rows - 1):
                    yield from _rows(b.column(0).take(pa.array(rows)), texts, values)
                    rows, texts, held = [], [], 0

    return kept.mapInArrow(run, schema)


def json_number(text: Column) -> Column:
    """A number that may be quoted; null if it is none."""
    return F.trim(F.translate(text, '"', "")).try_cast("double")


def json_text(text: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")[0]


def json_geometry(text: Column) -> Column:
    """Four or eight numbers from a list, nested lists, corners by name or a string; null otherwise."""
    number = r"(-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)"
    named = F.array(*(F.regexp_extract(text, rf'"{k}"\s*:\s*"?{number}', 1).try_cast("double") for k in ("xmin", "ymin", "xmax", "ymax")))
    listed = F.transform(F.regexp_extract_all(text, F.lit(number)), lambda x: x.cast("double"))
    form = F.when(F.trim(text).startswith("{"), named).otherwise(listed)
    return F.when(F.size(form).isin(4, 8) & ~F.exists(form, lambda x: x.isNull()), form)


def typed_objects(objects: DataFrame) -> DataFrame:
    """Members of ``export_objects`` as text, numbers and geometry of one form."""
    whole = lambda c: json_number(F.col(c)).cast("int").alias(c)
    return objects.select(
        "export_id", "kind", "path", "parent_path", "position",
        json_text(F.col("value")).alias("value"), json_text(F.col("type")).alias("type"),
        json_number(F.col("confidence")).alias("confidence"), json_number(F.col("objectness_score")).alias("objectness_score"),
        json_geometry(F.col("geometry")).alias("geometry"),
        F.from_json("crop_orientation", "value int, confidence double").alias("crop_orientation"),
        *(whole(c) for c in ("num_rows", "num_cols", "row_start", "row_end", "col_start", "col_end")),
    )
