"""Where the fields of a payload lie: a cursor over whole Arrow batches.

Rows of one layout move through its fields together, their positions in numpy arrays. The
cursor finds places only, and whether a field can be read; the text of a place is made by the rules of
:mod:`traceframe.functions.fields` in SQL, so there is one set of them. It looks at values
where a place depends on them: counts, lengths, prefixes, and numbers that must convert.

* Terminators: the zero bytes of a batch are found in one pass, those of a string by search.
* Arrays and structs whose elements have a fixed size are placed at once, their places being
  prefix sums over the counts; others step by element, all rows together.
* Elements leave as nested lists; nothing is copied element by element.

Layouts that need the text of a field before the next one can be placed (say, a length that is a
label or a GUID) are left to the fold of :mod:`traceframe.operators.decode`; see :func:`placeable`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: A carried or referenced length above this cannot fit any payload.
LENGTH_LIMIT = 1 << 27

#: Bytes of payload whose places are found at a time, give or take one record.
SLICE = 4 << 20
# ``spans``: property, place and size of every field and member in their order; at -1 has no value.
# ``entries``: shown fields, each with its span, or with the spans of its elements' members.
PLACES = (
    "struct<spans:array<struct<p:int,at:int,size:int>>,entries:array<struct<p:int,first:int,elements:array<array<int>>>>,"
    "bad:boolean,missing:boolean>"
)

_LONG = 1 << 63
# What the integer rules accept: blanks around, a sign, digits in groups.
_WHOLE = re.compile(r"[ \t\n\x0b\f\r]*[+-]?[0-9]+(?:_[0-9]+)*[ \t\n\x0b\f\r]*(?:\r\n|[\n\r\x85\u2028\u2029])?\Z")
_TEXTS = ("string", "char", "counted", "reversed", "rest")
_PLAIN_NUMBERS = ("signed", "unsigned", "port")


def placeable(properties: list[dict]) -> bool:
    """Whether every place in a layout follows from bytes, not from formatted text."""
    return all(_placeable(p) for p in properties if p["kind"] != "struct")


def _placeable(p: dict) -> bool:
    labelled, reader, form = bool(p["entries"]), p["reader"], p["form"]
    if p["kind"] == "array" and p["count_ref"] is None and p["count"] < 0:
        return False
    if p["carries"]:
        # The value is carried on as a number: of numbers and of texts.
        if labelled or (reader == "number" and form in ("float", "double")) or reader in ("binary", "hexdump"):
            return False
    if p["conversion"] == "int":
        return not labelled and reader not in ("binary", "hexdump")
    if p["conversion"] == "float":
        return not labelled and reader == "number" and form not in ("float", "double")
    return True


@dataclass
class _Read:
    """One field of some rows. ``at`` and ``size`` are of what is shown; ``at`` is -1 where nothing is."""

    next: np.ndarray
    carry: np.ndarray
    has: np.ndarray
    good: np.ndarray
    bad: np.ndarray
    at: np.ndarray
    size: np.ndarray
    number: np.ndarray
    known: np.ndarray


class Batch:
    """The payloads of a batch as one run of bytes."""

    def __init__(self, payloads: pa.Array):
        self.data = np.zeros(0, np.uint8)
        offsets = np.zeros(len(payloads) + 1, np.int64)
        if len(payloads):
            kind = np.int64 if pa.types.is_large_binary(payloads.type) else np.int32
            _, ends, values = payloads.buffers()
            offsets = np.frombuffer(ends, kind)[payloads.offset : payloads.offset + len(payloads) + 1].astype(np.int64)
            if values is not None:
                self.data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
        self.start = offsets[:-1]
        self.size = offsets[1:] - offsets[:-1]
        self._zeros: dict[tuple[int, int], np.ndarray] = {}

    def number(self, at: np.ndarray, width, big: bool = False) -> np.ndarray:
        """Numbers of ``width`` bytes (one for all, or one for each) as 64-bit patterns."""
        out = np.zeros(len(at), np.uint64)
        widths = np.broadcast_to(width, len(at))
        for i in range(int(widths.max(initial=0))):
            some = widths > i
            where = at[some] + (i if not big else widths[some] - 1 - i)
            out[some] |= self.data[where].astype(np.uint64) << np.uint64(8 * i)
        return out.view(np.int64)

    def terminated(self, at: np.ndarray, left: np.ndarray, unit: int) -> np.ndarray:
        """Bytes before the first terminator, aligned to the start, or up to the last whole character."""
        whole = left - left % unit
        out = whole.copy()
        for parity in range(unit):
            some = at % unit == parity
            zeros = self._terminators(unit, parity)
            if not some.any() or not len(zeros):
                continue
            found = np.searchsorted(zeros, at[some])
            place = np.where(found < len(zeros), zeros[np.minimum(found, len(zeros) - 1)], np.iinfo(np.int64).max)
            out[some] = np.minimum(whole[some], place - at[some])
        return out

    def _terminators(self, unit: int, parity: int) -> np.ndarray:
        """Places of zero characters, of those at even or odd places."""
        known = self._zeros.get((unit, parity))
        if known is None:
            zero = self.data == 0
            if unit == 2:
                zero = zero[:-1] & zero[1:]
            places = np.flatnonzero(zero)
            known = self._zeros[unit, parity] = places[places % unit == parity]
        return known

    def texts(self, at: np.ndarray, size: np.ndarray, unit: int) -> list[str]:
        """Texts up to their first NUL."""
        code = "utf-16-le" if unit == 2 else "latin-1"
        data = self.data.tobytes() if len(at) > 256 else None
        out = []
        for a, n in zip(at.tolist(), size.tolist(), strict=True):
            raw = data[a : a + n] if data is not None else self.data[a : a + n].tobytes()
            out.append(raw.decode(code, "replace").split("\0", 1)[0])
        return out


class _Rows:
    """The rows of one layout in a batch, at their cursors."""

    def __init__(self, batch: Batch, rows: np.ndarray, pointer: np.ndarray):
        self.batch, self.rows = batch, rows
        self.start, self.size, self.pointer = batch.start[rows], batch.size[rows], pointer[rows]
        n = len(rows)
        self.at, self.carry, self.has = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        self.alive, self.missing = np.ones(n, bool), np.zeros(n, bool)
        self.numbers: list[tuple[np.ndarray, np.ndarray] | None] = []

    def number(self, index: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the field at ``index`` and whether there is one."""
        known = self.numbers[index] if 0 <= index < len(self.numbers) else None
        if known is None:
            return np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        return known[0][rows], known[1][rows]

    def read(self, p: dict, rows: np.ndarray, at: np.ndarray, carry: np.ndarray, has: np.ndarray) -> _Read:
        """Read one field at ``at`` of ``rows``.

        A field of length 0 takes the carried length; a carried 0 means there is no value and ends
        the carrying. A field that cannot be read is passed by its declared length.
        """
        n = len(rows)
        left = self.size[rows] - at
        if p["length_ref"] is None:
            own, fails = np.full(n, p["length"], np.int64), np.zeros(n, bool)
        else:
            own, valid = self.number(p["length_ref"], rows)
            fails = ~valid
        applies = has & (own == 0)
        raw = np.where(applies, carry, own)
        skipped = applies & (carry == 0)
        length = np.where((raw >= 0) & (raw <= LENGTH_LIMIT), raw, -1)
        there = np.flatnonzero(~fails & ~skipped & (left > 0))

        out = _Read(
            at.copy(), carry, has & ~skipped, np.zeros(n, bool), fails, np.full(n, -1, np.int64), np.zeros(n, np.int64),
            np.zeros(n, np.int64), np.zeros(n, bool),
        )
        if not len(there):
            return out
        good, used, shown, size, number = self._place(p, rows[there], at[there], left[there], length[there])
        step = np.where(good, used, np.maximum(raw[there], 0))
        end = self.size[rows[there]]
        out.next[there] = np.where(step >= left[there], end, at[there] + step)
        out.good[there] = good
        out.at[there] = np.where(good, shown, -1)
        out.size[there] = np.where(good, size, 0)
        if number is not None:
            out.number[there] = np.where(good, number, 0)
            out.known[there] = good
        whole = there[good]
        if p["conversion"] in ("int", "float") and len(whole):
            out.bad = fails.copy()
            out.bad[whole] = ~self._converts(p, rows[whole], out.at[whole], out.size[whole])
        if p["carries"] and len(whole):
            value, castable = self._carried(p, rows[whole], out.at[whole], out.size[whole], out.number[whole])
            out.carry, out.has = carry.copy(), out.has.copy()
            out.carry[whole], out.has[whole] = value, castable
        return out

    def _place(self, p: dict, rows, at, left, length):
        """(readable, bytes used, place shown, its size, number) of one field."""
        batch, reader, unit = self.batch, p["reader"], p["unit"]
        n = len(rows)
        here = self.start[rows] + at
        none = np.zeros(n, np.int64)
        if reader == "number":
            width = np.full(n, p["width"], np.int64) if p["width"] is not None else self.pointer[rows]
            good = left >= width
            number = none.copy()
            number[good] = batch.number(here[good], width[good])
            if p["form"] == "time":
                good = good & ((number >= 0) | self._labelled(p, number))
            return good, width, at, width, number
        if reader in ("string", "char"):
            size = (np.ones(n, np.int64) if reader == "char" else length) * unit
            good = (size >= 0) & (left >= size)
            size = np.where(good, size, 0)
            used = size.copy()
            open_ = np.flatnonzero(good & (size == 0))
            if len(open_):
                taken = batch.terminated(here[open_], left[open_], unit)
                size[open_] = taken
                used[open_] = taken + np.where(taken + unit <= left[open_], unit, 0)
            return good, used, at, size, None
        if reader in ("counted", "reversed"):
            good = left >= 2
            count = none.copy()
            count[good] = batch.number(here[good], 2, big=reader == "reversed")
            good = good & (left >= count + 2)
            return good, count + 2, at + 2, count - count % unit, None
        if reader == "rest":
            return np.ones(n, bool), left, at, left - left % unit, None
        if reader == "fixed":
            good = left >= p["width"]
            if p["form"] == "clock":
                good = good.copy()
                some = np.flatnonzero(good)
                good[some] = self._clock(here[some])
            return good, np.full(n, p["width"], np.int64), at, np.full(n, p["width"], np.int64), None
        if reader == "binary":
            good = (length >= 0) & (left >= length)
            if p["form"] == "ipv6":
                good = good & (length == 16)
            elif p["form"] == "socket":
                good = good & (length >= 8)
                family = none.copy()
                family[good] = batch.number(here[good], 2)
                good = good & ((family == 2) | ((family == 23) & (length >= 24)))
            return good, length, at, length, None
        if reader == "sid":
            skip = self.pointer[rows] * 2 if p["form"] == "prefixed" else none
            good = left >= skip + 8
            size = none.copy()
            size[good] = batch.number(here[good] + skip[good] + 1, 1) * 4 + 8
            good = good & (left >= skip + size)
            return good, skip + size, at + skip, size, None
        if reader == "hexdump":
            good = left >= 4
            count = none.copy()
            count[good] = batch.number(here[good], 4)
            good = good & (left >= count + 4)
            return good, count + 4, at + 4, count, None
        return np.zeros(n, bool), none, at, none, None

    def _clock(self, here: np.ndarray) -> np.ndarray:
        """Whether eight 16-bit numbers are a valid time."""
        year, month, _, day, hour, minute, second, milli = (self.batch.number(here + 2 * i, 2) for i in range(8))
        leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
        days = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.where(month <= 12, month, 0)]
        days = days + (leap & (month == 2))
        return (day >= 1) & (day <= days) & (hour < 24) & (minute < 60) & (second < 60) & (milli < 1000)

    def _labelled(self, p: dict, number: np.ndarray) -> np.ndarray:
        if not p["entries"]:
            return np.zeros(len(number), bool)
        values = np.array([e["value"] for e in p["entries"]], np.int64)
        if p["is_bitmap"]:
            return (number & np.bitwise_or.reduce(values)) != 0
        return np.isin(number, values)

    def _texts(self, p: dict, rows, at, size) -> list[str]:
        return self.batch.texts(self.start[rows] + at, size, p["unit"])

    def _converts(self, p: dict, rows, at, size) -> np.ndarray:
        if p["reader"] == "number":
            return np.full(len(rows), p["form"] in _PLAIN_NUMBERS)
        if p["reader"] in _TEXTS:
            return np.array([_WHOLE.match(t) is not None for t in self._texts(p, rows, at, size)], bool)
        return np.zeros(len(rows), bool)

    def _carried(self, p: dict, rows, at, size, number) -> tuple[np.ndarray, np.ndarray]:
        """The value as a length for later fields, and whether it is a whole number."""
        n = len(rows)
        if p["reader"] in _TEXTS:
            values = [_length(t) for t in self._texts(p, rows, at, size)]
            return np.array([v or 0 for v in values], np.int64), np.array([v is not None for v in values], bool)
        if p["reader"] != "number" or p["form"] not in _PLAIN_NUMBERS:
            return np.zeros(n, np.int64), np.zeros(n, bool)
        if p["form"] == "signed":
            shift = 64 - 8 * p["width"]
            value = (number << shift) >> shift
        elif p["form"] == "port":
            value = ((number & 0xFF) << 8) | (number >> 8)
        else:
            value = np.where(number < 0, LENGTH_LIMIT + 1, number)
        return value, np.ones(n, bool)

    def steady(self, members: list[dict], rows: np.ndarray) -> np.ndarray | None:
        """Bytes of one element of each row, where that is certain; None where it depends on values."""
        total = np.zeros(len(rows), np.int64)
        for p in members:
            fixed = p["reader"] == "number" and p["form"] != "time" or p["reader"] == "fixed" and p["form"] != "clock"
            if not fixed or p["carries"] or p["length_ref"] is not None or p["conversion"] in ("int", "float"):
                return None
            total += p["width"] if p["width"] is not None else self.pointer[rows]
        return total


def _length(text: str) -> int | None:
    """A text as a carried length; one too large for any payload still carries."""
    bare = text.strip("".join(map(chr, range(33))))
    if re.fullmatch(r"[+-]?[0-9]+", bare) and -_LONG <= int(bare) < _LONG:
        return int(bare)
    return LENGTH_LIMIT + 1 if _WHOLE.match(text) else None


class Places:
    """What has been placed in a batch, field by field, until it is put in order."""

    def __init__(self, rows: int):
        self.rows = rows
        self.bad, self.missing = np.zeros(rows, bool), np.zeros(rows, bool)
        self.entries: list[tuple[np.ndarray, ...]] = []  # row, property, at, size, nested
        self.spans: list[tuple[np.ndarray, ...]] = []  # row, property, element, member, at, size

    def layout(self, batch: Batch, layout: list[dict], rows: np.ndarray, pointer: np.ndarray) -> None:
        """Move the rows of one layout through its fields."""
        r = _Rows(batch, rows, pointer)
        taken: dict[str, list[int]] = {}
        for index, p in enumerate(layout):
            live = np.flatnonzero(r.alive) if p["top_level"] else np.zeros(0, np.int64)
            number = None
            if len(live):
                if p["kind"] == "plain":
                    shown, number = self._plain(r, p, index, live)
                else:
                    shown = self._repeated(r, p, index, layout, live)
                if shown is not None and not p["hidden"]:
                    before = taken.setdefault(p["name"], [])
                    for i in before:  # a repeated name keeps its last value
                        row, q, at, size, nested = self.entries[i]
                        keep = ~np.isin(row, rows[shown], assume_unique=True)
                        self.entries[i] = (row[keep], q[keep], at[keep], size[keep], nested[keep])
                        self._drop_spans(q[:1], rows[shown])
                    before.append(len(self.entries) - 1)
            r.numbers.append(number)
        self.bad[rows] = ~r.alive
        self.missing[rows] = r.missing

    def _drop_spans(self, p: np.ndarray, rows: np.ndarray) -> None:
        for i, span in enumerate(self.spans):
            if len(p) and len(span[0]) and span[1][0] == p[0]:
                keep = ~np.isin(span[0], rows)
                self.spans[i] = tuple(x[keep] for x in span)

    def _plain(self, r: _Rows, p: dict, index: int, live: np.ndarray):
        x = r.read(p, live, r.at[live], r.carry[live], r.has[live])
        ok = ~x.bad
        r.alive[live[x.bad]] = False
        some = live[ok]
        r.at[some], r.carry[some], r.has[some] = x.next[ok], x.carry[ok], x.has[ok]
        value, known = np.zeros(len(r.rows), np.int64), np.zeros(len(r.rows), bool)
        value[some], known[some] = x.number[ok], x.known[ok]
        if not p["hidden"]:
            r.missing[some] |= ~x.good[ok]
            self._entries(r.rows[some], index, x.at[ok], x.size[ok], False)
        return some, (value, known)

    def _entries(self, rows: np.ndarray, index: int, at, size, nested: bool) -> None:
        n = len(rows)
        self.entries.append((rows, np.full(n, index, np.int32), at, size, np.full(n, nested)))

    def _repeated(self, r: _Rows, p: dict, index: int, layout: list[dict], live: np.ndarray) -> np.ndarray | None:
        """An array is elements of the property itself, a struct elements of several members."""
        is_struct = p["kind"] == "struct"
        first = (p["struct_start"] or 0) if is_struct else index
        members = layout[first : first + (p["struct_members"] or 0)] if is_struct else [p]
        if p["count_ref"] is not None:
            count, valid = r.number(p["count_ref"], live)
        else:
            count, valid = np.full(len(live), p["count"], np.int64), np.ones(len(live), bool)
        bad = ~valid | (count > r.size[live]) | (is_struct and p["fixed_count"])
        r.alive[live[bad]] = False
        rows, count = live[~bad], np.maximum(count[~bad], 0)
        at, carry, has = r.at[rows], r.carry[rows], r.has[rows]
        failed, missing, done = np.zeros(len(rows), bool), np.zeros(len(rows), bool), np.zeros(len(rows), np.int64)
        found: list[tuple[np.ndarray, ...]] = []  # place in rows, element, member, at, size

        stride = r.steady(members, rows)
        if stride is not None and members:
            # Whole elements at once. A carried 0 would skip members without a length of their own.
            plain = ~(has & (carry == 0)) | all(m["length"] for m in members)
            done = np.where(plain, np.minimum(count, (r.size[rows] - at) // np.maximum(stride, 1)), 0)
            which = np.repeat(np.arange(len(rows)), done)
            element = np.arange(len(which)) - np.repeat(np.cumsum(done) - done, done)
            place = at[which] + element * stride[which]
            for m, member in enumerate(members):
                width = np.full(len(which), member["width"]) if member["width"] is not None else r.pointer[rows][which]
                found.append((which, element, np.full(len(which), first + m), place, width))
                place = place + width
            at = at + done * stride
        element = done.copy()
        active = np.flatnonzero(element < count)
        while len(active):
            for m, member in enumerate(members):
                x = r.read(member, rows[active], at[active], carry[active], has[active])
                failed[active] |= x.bad
                ok = ~x.bad
                some = active[ok]
                at[some], carry[some], has[some] = x.next[ok], x.carry[ok], x.has[ok]
                missing[some] |= ~x.good[ok]
                found.append((some, element[some], np.full(len(some), first + m), x.at[ok], x.size[ok]))
                active = some
            element[active] += 1
            active = active[element[active] < count[active]]
        r.alive[rows[failed]] = False
        ok = ~failed
        r.at[rows[ok]], r.carry[rows[ok]], r.has[rows[ok]] = at[ok], carry[ok], has[ok]
        if p["hidden"]:
            return None
        r.missing[rows[ok]] |= (count[ok] == 0) | missing[ok]
        shown = rows[ok & (count > 0)]
        self._entries(r.rows[shown], index, np.full(len(shown), -1), np.zeros(len(shown), np.int64), True)
        last = {m["name"]: first + i for i, m in enumerate(members)}
        kept = np.array([first + i for i, m in enumerate(members) if last[m["name"]] == first + i], np.int64)
        for which, el, member, place, size in found:
            keep = ~failed[which] & np.isin(member, kept)
            which = which[keep]
            self.spans.append(
                (r.rows[rows[which]], np.full(len(which), index, np.int32), el[keep], member[keep], place[keep], size[keep])
            )
        return shown

    def column(self) -> pa.StructArray:
        """All of it as ``PLACES``, fields in the order of their properties."""
        row, p, at, size, nested = _joined(self.entries, 5)
        order = np.lexsort((p, row))
        row, p, at, size, nested = row[order], p[order], at[order], size[order], nested[order].astype(bool)
        s_row, s_p, s_el, s_member, s_at, s_size = _joined(self.spans, 6)
        # Spans of fields and of members in one order: by row, field, element, member.
        alone = ~nested
        none = np.zeros(int(alone.sum()), np.int64)
        keys = [np.concatenate(x) for x in ((none, s_member), (none, s_el), (p[alone], s_p), (row[alone], s_row))]
        order = np.lexsort(tuple(keys))
        member, el, field, of = (k[order] for k in keys)
        what = np.concatenate([p[alone], s_member])[order]
        spans = _struct(["p", "at", "size"], [what, np.concatenate([at[alone], s_at])[order], np.concatenate([size[alone], s_size])[order]])
        per_row = np.bincount(of, minlength=self.rows) if len(of) else np.zeros(self.rows, np.int64)
        begin = np.cumsum(per_row) - per_row
        place = np.arange(len(of)) - begin[of]  # within its row
        # A new element wherever row, field or element change; its entry wherever row or field do.
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (field[1:] != field[:-1]) | (el[1:] != el[:-1])
        starts = np.flatnonzero(new)
        key = of[starts].astype(np.int64) << 32 | field[starts].astype(np.int64)
        own = row.astype(np.int64) << 32 | p.astype(np.int64)
        first = np.searchsorted(key, own, "left")
        if nested.any():
            elements = pa.ListArray.from_arrays(pa.array(np.append(starts, len(of)), pa.int32()), pa.array(place, pa.int32()))
            # Elements of plain fields are in no list: take those of nested ones.
            counts = np.where(nested, np.searchsorted(key, own, "right") - first, 0)
            taken = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
            ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            lists = pa.ListArray.from_arrays(ends, elements.take(pa.array(taken, pa.int64())), mask=pa.array(alone))
        else:
            lists = pa.nulls(len(row), pa.list_(pa.list_(pa.int32())))
        at_first = place[starts[first]] if len(starts) else np.zeros(0, np.int64)
        entries = pa.StructArray.from_arrays([pa.array(p, pa.int32()), pa.array(at_first, pa.int32()), lists], ["p", "first", "elements"])
        by_row = np.bincount(row, minlength=self.rows) if len(row) else np.zeros(self.rows, np.int64)
        ends = [pa.array(np.append(0, np.cumsum(n)), pa.int32()) for n in (per_row, by_row)]
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(ends[0], spans), pa.ListArray.from_arrays(ends[1], entries),
                pa.array(self.bad), pa.array(self.missing),
            ],
            ["spans", "entries", "bad", "missing"],
        )


def _joined(parts: list[tuple[np.ndarray, ...]], width: int) -> list[np.ndarray]:
    if not parts:
        return [np.zeros(0, np.int64) for _ in range(width)]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _struct(names: list[str], values: list[np.ndarray]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in values], names)


def places(layouts: dict[int, list[dict]]):
    """An Arrow function of payload, layout id and pointer size: ``PLACES`` of each row.

    ``layouts`` are property rows by layout id, of :func:`placeable` layouts. Rows of other
    layouts have no entries.
    """

    @F.arrow_udf(PLACES)
    def find(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for payloads, layout_ids, pointers in batches:
            ids = layout_ids.fill_null(-1).to_numpy(zero_copy_only=False)
            pointer = pointers.to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [
                _find(layouts, payloads.slice(a, b - a), ids[a:b], pointer[a:b]) for a, b in _slices(payloads)
            ]
            yield parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    return find


def _slices(payloads: pa.Array) -> list[tuple[int, int]]:
    """Runs of rows with about ``SLICE`` bytes of payload."""
    sizes = pc.fill_null(pc.binary_length(payloads), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE
    cuts = (np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(payloads)], strict=True))


def _find(layouts: dict[int, list[dict]], payloads: pa.Array, ids: np.ndarray, pointer: np.ndarray) -> pa.StructArray:
    batch, found = Batch(payloads), Places(len(payloads))
    order = np.argsort(ids, kind="stable")
    kinds, begins = np.unique(ids[order], return_index=True)
    for kind, rows in zip(kinds.tolist(), np.split(order, begins[1:]), strict=True):
        rows = rows[batch.size[rows] > 0]
        if kind in layouts and len(rows):
            found.layout(batch, layouts[kind], rows, pointer)
    return found.column()
