"""Payload decode: BINARY payload -> named text fields, driven by the manifest.

Three ways, one set of field rules (:mod:`traceframe.functions.fields`):

* **Compiled.** Layouts of plain fields become column expressions under a ``CASE`` on the
  layout id. Fields before the first one of variable length have constant offsets and
  become generated code; from there on each position is bound once and used by what
  follows. No scan, join or union per layout.
* **By table.** Layouts with structs or arrays, and those beyond
  ``MAX_COMPILED_LAYOUTS``, are read by their property rows, which
  arrive as an array column of the broadcast manifest. The plan does not grow with the
  manifest. An Arrow cursor (:mod:`traceframe.operators.cursor`) finds the place of every
  field of a batch; the texts of the places are then made by SQL.
* **Folded.** The few layouts in which a place depends on formatted text are folded field by field over
  their property rows instead, as all are with ``table_driven="fold"``.

All are row-local: no shuffle, so skewed providers or processes do not matter, and
predicates on header columns still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe.functions import bits, fields
from traceframe.functions.bits import let
from traceframe.functions.fields import Source
from traceframe.functions.reuse import per_application
from traceframe.functions.text import is_int_text
from traceframe.operators import cursor
from traceframe.operators.manifest import Layout, Manifest, Property, attach_manifest, local_table
from traceframe.workers import visible

LENGTH_LIMIT = cursor.LENGTH_LIMIT

PAYLOAD_TYPE = "map<string,string>"


def _empty_payload() -> Column:
    return F.create_map().cast(PAYLOAD_TYPE)


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _bounded_length(length: Column) -> Column:
    """A length as INT; -1 for one no payload can hold."""
    return F.when((length >= 0) & (length <= LENGTH_LIMIT), length).otherwise(-1).cast("int")


class _Record:
    """The columns of one record that field rules look at."""

    def __init__(self, data: Column, size: Column, pointer: Column):
        self.data, self.size, self.pointer = data, size, pointer


class _RowProperty:
    """A property row as columns, under the names of a static :class:`Property`."""

    NAMES = (
        "name", "hidden", "kind", "reader", "form", "width", "unit", "conversion", "length",
        "length_ref", "count", "count_ref", "fixed_count", "carries", "is_bitmap", "entries",
        "struct_start", "struct_members", "top_level",
    )

    def __init__(self, row: Column):
        for name in self.NAMES:
            setattr(self, name, row[name])

    def label(self, value: Column) -> Column:
        hits = F.transform(
            F.filter(
                self.entries,
                lambda e: F.when(
                    self.is_bitmap, value.bitwiseAND(e["value"]) != 0
                ).otherwise(value == e["value"]),
            ),
            lambda e: e["label"],
        )
        return F.when(F.size(self.entries) > 0, F.nullif(F.array_join(hits, " | "), F.lit("")))


class _StaticProperty:
    """A property of a layout that is being compiled."""

    def __init__(self, prop: Property, label_map: tuple | None):
        self.name, self.in_type, self.out_type = prop.name, prop.in_type, prop.out_type
        ipv6 = prop.in_type == C.IN_BINARY and prop.out_type == C.OUT_IPV6
        self.length = 16 if ipv6 else prop.length
        self.length_ref = _length_ref(prop)
        self.carries = prop.name.lower().endswith("length")
        self.map = label_map

    @property
    def label(self):
        if self.map is None:
            return None
        is_bitmap, entries = self.map

        def label(value: Column) -> Column:
            if is_bitmap:
                hits = [
                    F.when(value.bitwiseAND(F.lit(mask)) != 0, F.lit(name))
                    for mask, name in entries
                ]
                return F.nullif(F.concat_ws(" | ", *hits), F.lit(""))
            out = None
            for number, name in entries:
                test = value == number
                out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
            return out

        return label

    @property
    def width(self) -> int | None:
        """Bytes by which the position always moves, when that is certain."""
        width = fields.width_of(self.in_type)
        if width is None or self.length_ref is not None or self.length < width:
            return None
        if self.length > width and self.in_type in fields.MAY_BE_INVALID:
            return None
        return width

    @property
    def can_fail(self) -> bool:
        return self.length_ref is not None or fields.may_not_convert(
            self.in_type, self.out_type, self.map is not None
        )


def _length_ref(prop: Property) -> int | None:
    if not prop.flags & C.PROP_PARAM_LENGTH:
        return None
    return prop.length_index if prop.length_index is not None else prop.length


def _read(prop, source: Source) -> Column:
    """One field as ``READ_TYPE``; NULL when its bytes are not there."""
    if isinstance(prop, _RowProperty):
        return fields.read_row(source, prop, prop.label)
    value = fields.read_field(source, prop.in_type, prop.out_type, prop.label)
    return F.when(value.fits, value.read())


def _convert(prop, text: Column) -> tuple[Column, Column]:
    if isinstance(prop, _RowProperty):
        return fields.convert_row(text, prop.conversion)
    return fields.convert(text, prop.out_type)


def _read_field(record: _Record, at: Column, carry: Column | None, number_of, prop) -> Column:
    """Read one plain field at ``at``: next position, carry, failure and value.

    A field of length 0 takes the length carried from the last field whose name ends in
    ``length``; a carried 0 means there is no value and ends the carrying. A field past
    the end, or one that cannot be read, is NULL; in the latter case reading goes on
    after its declared length.
    """
    size = record.size

    def result(at, carry, bad, value, number) -> Column:
        return F.struct(
            at.cast("bigint").alias("at"), carry.alias("carry"), bad.alias("bad"),
            value.alias("value"), number.alias("number"),
        )

    carried = _null("bigint") if carry is None else carry
    nothing, no = _null("string"), F.lit(False)

    def with_lengths(raw, skipped: Column | None) -> Column:
        length = _bounded_length(raw) if isinstance(raw, Column) else raw
        left = (size - at).cast("int")
        source = Source(record.data, at.cast("int"), left, length, record.pointer)
        declared = F.greatest(bits.as_col(raw).cast("bigint"), F.lit(0).cast("bigint"))

        def finish(read: Column) -> Column:
            text = read["text"]
            good = text.isNotNull()
            converted, failed = _convert(prop, text)
            step = F.when(good, read["used"]).otherwise(declared)
            # Whole numbers too large for a BIGINT still carry: as a length that never fits.
            new_carry = F.coalesce(
                text.try_cast("bigint"),
                F.when(is_int_text(text), F.lit(LENGTH_LIMIT + 1).cast("bigint")),
            )
            if isinstance(prop.carries, Column):
                new_carry = F.when(prop.carries & good, new_carry).otherwise(carried)
            else:
                new_carry = F.when(good, new_carry).otherwise(carried) if prop.carries else carried
            return result(
                F.when(step >= size - at, size).otherwise(at + step),
                new_carry,
                failed,
                converted,
                F.when(good, read["number"]),
            )

        absent_carry = carried if skipped is None else F.when(~skipped, carried)
        absent = result(at, absent_carry, no, nothing, _null("bigint"))
        past = left <= 0 if skipped is None else skipped | (left <= 0)
        return F.when(past, absent).otherwise(let(_read(prop, source), finish))

    def with_own(own) -> Column:
        if carry is None or (not isinstance(own, Column) and own != 0):
            return with_lengths(own, None)
        applies = carry.isNotNull() & (bits.as_col(own) == 0)
        both = F.struct(
            F.when(applies, carry).otherwise(bits.as_col(own).cast("bigint")).alias("raw"),
            (applies & (F.coalesce(carry, F.lit(1)) == 0)).alias("skipped"),
        )
        return let(both, lambda b: with_lengths(b["raw"], b["skipped"]))

    def with_reference(number: Column) -> Column:
        return F.when(
            number.isNull(), result(at, carried, F.lit(True), nothing, _null("bigint"))
        ).otherwise(with_own(number))

    if isinstance(prop.length_ref, Column):
        own = F.when(prop.length_ref.isNull(), prop.length.cast("bigint")).otherwise(
            number_of(prop.length_ref)
        )
        return let(own, with_reference)
    if prop.length_ref is not None:
        return let(number_of(prop.length_ref), with_reference)
    return with_own(prop.length)


# --------------------------------------------------------------------------------------
# compiled layouts
# --------------------------------------------------------------------------------------


class _CompiledLayout:
    """Expressions of one layout: fields at constant offsets, then the rest.

    ``head`` are the fields up to the first whose end is not known while planning; their
    texts are independent expressions. ``tail`` decodes what follows in order and gives
    the values, or is None.
    """

    def __init__(self, layout: Layout, record: _Record, tail: Column):
        self.record = record
        self.props = [_StaticProperty(p, layout.map_of(p)) for p in layout.top]
        self.ordinals = [p.ordinal for p in layout.top]
        self.head: list[tuple[str, Column]] = []
        self.unread: list[Column] = []
        # Bytes and pointers before the next field; a plain number as long as it can be.
        const, pointers, i = 0, 0, 0

        def at():
            return record.pointer * pointers + const if pointers else const

        while i < len(self.props) and self._inline(i, at()):
            prop = self.props[i]
            if prop.in_type in fields.POINTER_TYPES:
                pointers += 1
            else:
                const += prop.width or 0
            i += 1
        self.tail = None
        if i < len(self.props):
            self.tail = self._values(i, bits.as_col(at()).cast("bigint"), None, [], {})
        self.tail_names = [p.name for p in self.props[i:] if p.out_type != C.OUT_NOPRINT]
        self.tail_column = tail

    def _inline(self, i: int, at: Column | int) -> bool:
        """Take field ``i`` into the head if it can be read on its own."""
        prop, later = self.props[i], self.props[i + 1 :]
        referenced = any(p.length_ref == self.ordinals[i] for p in later)
        carries = prop.carries and any(p.length == 0 or p.length_ref is not None for p in later)
        if prop.can_fail or referenced or carries or (later and prop.width is None):
            return False
        if prop.width is None and prop.length_ref is not None:
            return False
        left = self.record.size - at
        source = Source(self.record.data, at, left, prop.length, self.record.pointer)
        bitmap, entries = prop.map or (False, [])
        shown = fields.read_inline(source, prop.in_type, prop.out_type, bitmap, entries)
        if shown is None:
            return False
        if prop.out_type == C.OUT_NOPRINT:
            return True
        fits = (left > 0) & fields.inline_fits(source, prop.in_type)
        value = fields.convert(F.when(fits, shown), prop.out_type)[0]
        self.head.append((prop.name, value))
        invalid = prop.in_type in fields.MAY_BE_INVALID
        self.unread.append(value.isNull() if invalid else ~fits)
        return True

    def _values(self, i: int, at: Column, carry, shown: list, numbers: dict) -> Column:
        """Values of the fields from ``i`` on, and whether the record failed there."""
        if i == len(self.props):
            return self._tail(shown, failed=False)
        prop = self.props[i]

        def use(read: Column) -> Column:
            next_carry = read["carry"] if prop.carries or carry is not None else None
            more = {**numbers, self.ordinals[i]: read["number"]}
            hidden = prop.out_type == C.OUT_NOPRINT
            values = shown if hidden else [*shown, read["value"]]
            rest = self._values(i + 1, read["at"], next_carry, values, more)
            if not prop.can_fail:
                return rest
            return F.when(read["bad"], self._tail(shown, failed=True)).otherwise(rest)

        def number_of(index: int) -> Column:
            return numbers.get(index, _null("bigint"))

        return let(_read_field(self.record, at, carry, number_of, prop), use)

    @staticmethod
    def _tail(shown: list, failed: bool) -> Column:
        values = F.array(*shown) if shown else F.array().cast("array<string>")
        return F.struct(values.alias("values"), F.lit(failed).alias("bad"))

    @property
    def payload(self) -> Column:
        """Map of all fields read; a repeated name keeps its last value."""
        if self.tail is None or not any(p.can_fail for p in self.props):
            values = self.tail_column["values"]
            tail = [(name, F.get(values, F.lit(i))) for i, name in enumerate(self.tail_names)]
            return self._map([*self.head, *tail])
        # Fields after a record error are absent: keep as many names as there are values.
        values = self.tail_column["values"]
        names = F.array(*[F.lit(name) for name in self.tail_names])
        pairs = F.arrays_zip(F.slice(names, F.lit(1), F.size(values)).alias("name"), values.alias("value"))
        tail = _last_wins(F.transform(pairs, lambda p: F.struct(p["name"].alias("name"), p["value"].alias("value"))))
        later = set(self.tail_names)
        return F.map_concat(self._map([h for h in self.head if h[0] not in later]), tail)

    @staticmethod
    def _map(shown: list) -> Column:
        named = dict(shown)
        if not named:
            return _empty_payload()
        return F.create_map(*[x for name, value in named.items() for x in (F.lit(name), value)])

    @property
    def bad(self) -> Column:
        return F.lit(False) if self.tail is None else self.tail_column["bad"]

    @property
    def missing(self) -> Column:
        out = F.lit(False)
        for unread in self.unread:
            out = out | unread
        if self.tail is not None:
            out = out | F.exists(self.tail_column["values"], lambda v: v.isNull())
        return out


def _by_layout(branches: list[tuple[int, Column]]) -> Column:
    """``CASE`` over sorted layout ids as a balanced tree."""
    if len(branches) <= 4:
        out = None
        for layout_id, value in branches:
            test = F.col("layout_id") == layout_id
            out = F.when(test, value) if out is None else out.when(test, value)
        return out
    middle = len(branches) // 2
    return F.when(
        F.col("layout_id") < branches[middle][0], _by_layout(branches[:middle])
    ).otherwise(_by_layout(branches[middle:]))


# --------------------------------------------------------------------------------------
# table-driven layouts
# --------------------------------------------------------------------------------------

PROPERTY_ROWS = """
    layout_id INT, _by_cursor BOOLEAN,
    _properties ARRAY<STRUCT<ordinal: INT, name: STRING, hidden: BOOLEAN, kind: STRING,
        reader: STRING, form: STRING, width: INT, unit: INT, conversion: STRING, length: INT, length_ref: INT, count: INT, count_ref: INT,
        fixed_count: BOOLEAN, carries: BOOLEAN, is_bitmap: BOOLEAN,
        entries: ARRAY<STRUCT<value: BIGINT, label: STRING>>,
        struct_start: INT, struct_members: INT, top_level: BOOLEAN>>
"""


def _property_rows(layout: Layout) -> list[dict]:
    out = []
    for p in layout.properties:
        is_bitmap, entries = layout.map_of(p) or (False, [])
        ipv6 = p.in_type == C.IN_BINARY and p.out_type == C.OUT_IPV6
        out.append(
            {
                "ordinal": p.ordinal,
                "name": p.name,
                "hidden": p.out_type == C.OUT_NOPRINT,
                **fields.reading_of(p.in_type, p.out_type, bool(entries)),
                "kind": "struct" if p.is_struct else "array" if p.is_array else "plain",
                "length": 16 if ipv6 else p.length,
                "length_ref": _length_ref(p),
                "count": p.count,
                "count_ref": p.count_index if p.flags & C.PROP_PARAM_COUNT else None,
                "fixed_count": bool(p.flags & C.PROP_PARAM_FIXED_COUNT)
                and not p.flags & C.PROP_PARAM_COUNT,
                "carries": p.name.lower().endswith("length"),
                "is_bitmap": is_bitmap,
                "entries": [{"value": v, "label": name} for v, name in entries],
                "struct_start": p.struct_start,
                "struct_members": p.struct_members,
                "top_level": p.top_level,
            }
        )
    return out


_ENTRY = "struct<name:string,value:string>"


def _last_wins(entries: Column) -> Column:
    """Entries to a map; a repeated name keeps its last value."""
    kept = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["name"] == e["name"]
        ),
    )
    return F.map_from_entries(kept)


def _element_count(numbers: Column, prop: _RowProperty) -> Column:
    """Elements of an array; NULL when the counting field has no value."""
    return F.when(prop.count_ref.isNotNull(), F.get(numbers, prop.count_ref)).otherwise(
        prop.count.cast("bigint")
    )


def _steps(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def _struct_of(**columns: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in columns.items()])


def _table_driven(record: _Record, properties: Column) -> Column:
    """Fold the property rows over one payload.

    An array is ``count`` elements with the property itself as the only member, a struct
    is ``count`` elements of several members; plain fields take the short way.
    """
    no_members = F.array().cast(f"array<{_ENTRY}>")

    def step(acc: Column, row: Column) -> Column:
        prop = _RowProperty(row)
        is_struct = prop.kind == "struct"
        members = F.when(
            is_struct, F.slice(properties, prop.struct_start + 1, prop.struct_members)
        ).otherwise(F.array(row))

        def read_member(so_far: Column, member_row: Column) -> Column:
            member = _RowProperty(member_row)
            read = _read_field(
                record, so_far["at"], so_far["carry"],
                lambda index: F.get(acc["numbers"], index), member,
            )

            def use(r: Column) -> Column:
                entry = F.struct(member.name.alias("name"), r["value"].alias("value"))
                return _struct_of(at=r["at"], carry=r["carry"], bad=r["bad"],
                    missing=so_far["missing"] | r["value"].isNull(),
                    elements=so_far["elements"],
                    members=F.concat(so_far["members"], F.array(entry)),
                )

            return F.when(so_far["bad"], so_far).otherwise(let(read, use))

        def read_element(so_far: Column, _) -> Column:
            def use(one: Column) -> Column:
                return _struct_of(at=one["at"], carry=one["carry"], bad=one["bad"], missing=one["missing"],
                    elements=F.concat(one["elements"], F.array(_last_wins(one["members"]))),
                    members=no_members,
                )

            return F.when(so_far["bad"], so_far).otherwise(
                let(F.aggregate(members, so_far, read_member), use)
            )

        start = _struct_of(at=acc["at"], carry=acc["carry"], bad=F.lit(False), missing=F.lit(False),
            elements=F.array().cast("array<map<string,string>>"), members=no_members,
        )
        count = _element_count(acc["numbers"], prop)

        def record_error() -> Column:
            return _struct_of(at=acc["at"], carry=acc["carry"], bad=F.lit(True),
                missing=acc["missing"], entries=acc["entries"], numbers=acc["numbers"],
            )

        hidden = prop.hidden

        def plain(read: Column) -> Column:
            entry = F.struct(prop.name.alias("name"), read["value"].alias("value"))
            return F.when(read["bad"], record_error()).otherwise(
                _struct_of(at=read["at"], carry=read["carry"], bad=F.lit(False),
                    missing=acc["missing"] | (~hidden & read["value"].isNull()),
                    entries=F.when(hidden, acc["entries"]).otherwise(
                        F.concat(acc["entries"], F.array(entry))
                    ),
                    numbers=F.concat(acc["numbers"], F.array(read["number"])),
                )
            )

        def add(done: Column) -> Column:
            lists = F.transform(done["elements"], lambda e: F.element_at(F.map_values(e), 1))
            keep_nulls = {"ignoreNullFields": "false"}
            shown = F.when(is_struct, F.to_json(done["elements"], keep_nulls)).otherwise(
                F.to_json(lists, keep_nulls)
            )
            empty = F.size(done["elements"]) == 0
            entry = F.struct(prop.name.alias("name"), shown.alias("value"))
            return F.when(done["bad"], record_error()).otherwise(
                _struct_of(at=done["at"], carry=done["carry"], bad=F.lit(False),
                    missing=acc["missing"] | (~hidden & (empty | done["missing"])),
                    entries=F.when(empty | hidden, acc["entries"]).otherwise(
                        F.concat(acc["entries"], F.array(entry))
                    ),
                    numbers=F.concat(acc["numbers"], F.array(_null("bigint"))),
                )
            )

        def with_count(n: Column) -> Column:
            impossible = n.isNull() | (n > record.size) | (is_struct & prop.fixed_count)
            return F.when(impossible, record_error()).otherwise(
                let(F.aggregate(_steps(n), start, read_element), add)
            )

        # Members are read by their struct; they only keep their place among the numbers,
        # which are indexed by ordinal.
        member_place = _struct_of(at=acc["at"], carry=acc["carry"], bad=acc["bad"], missing=acc["missing"],
            entries=acc["entries"],
            numbers=F.concat(acc["numbers"], F.array(_null("bigint"))),
        )
        return (
            F.when(acc["bad"], acc)
            .when(~prop.top_level, member_place)
            .when(
                prop.kind == "plain",
                let(
                    _read_field(
                        record, acc["at"], acc["carry"],
                        lambda index: F.get(acc["numbers"], index), prop,
                    ),
                    plain,
                ),
            )
            .otherwise(let(count, with_count))
        )

    start = _struct_of(at=F.lit(0).cast("bigint"), carry=_null("bigint"), bad=F.lit(False), missing=F.lit(False),
        entries=no_members, numbers=F.array().cast("array<bigint>"),
    )
    return F.aggregate(
        properties,
        start,
        step,
        lambda s: _struct_of(payload=_last_wins(s["entries"]), bad=s["bad"], missing=s["missing"]
        ),
    )


def _placed(record: _Record, places: Column, properties: Column, kinds: fields.Kinds) -> Column:
    """Texts and names of the places that the cursor has found."""

    def texts(data: Column) -> Column:
        def text_of(span: Column) -> Column:
            def use(row: Column) -> Column:
                prop = _RowProperty(row)
                shown = fields.show_row(data, span["at"], span["size"], prop, prop.label, kinds)
                value = F.when(span["at"] >= 0, fields.convert_shown(shown, prop.conversion, kinds))
                return F.struct(prop.name.alias("name"), value.alias("value"))

            return let(F.get(properties, span["p"]), use)

        return F.transform(places["spans"], text_of)

    def entries(texts: Column) -> Column:
        def plain(entry: Column) -> Column:
            return F.get(texts, entry["first"])

        def repeated(entry: Column) -> Column:
            prop = _RowProperty(F.get(properties, entry["p"]))
            members = F.transform(entry["elements"], lambda e: F.transform(e, lambda i: F.get(texts, i)))
            keep_nulls = {"ignoreNullFields": "false"}
            as_struct = F.to_json(F.transform(members, F.map_from_entries), keep_nulls)
            as_list = F.to_json(F.transform(members, lambda m: F.get(m, 0)["value"]), keep_nulls)
            shown = F.when(prop.kind == "struct", as_struct).otherwise(as_list)
            return F.struct(prop.name.alias("name"), shown.alias("value"))

        if not kinds.repeated:
            return texts
        return F.transform(
            places["entries"], lambda e: F.when(e["elements"].isNull(), plain(e)).otherwise(repeated(e))
        )

    # The payload is bound once: each mention of a binary column copies all of it.
    named = let(let(record.data, texts), entries)
    return _struct_of(payload=F.map_from_entries(named), bad=places["bad"], missing=places["missing"])


# --------------------------------------------------------------------------------------
# the operator
# --------------------------------------------------------------------------------------


def _record() -> _Record:
    return _Record(F.col("UserData"), F.col("_size"), F.col("_pointer"))


@per_application
def _fold_expression() -> Column:
    return _table_driven(_record(), F.col("_properties"))


@per_application
def _placed_expression(kinds: fields.Kinds) -> Column:
    return _placed(_record(), F.col("_places"), F.col("_properties"), kinds)


def _compiled(manifest: Manifest, layout: Layout) -> _CompiledLayout:
    """Compiled layouts are kept with their manifest."""
    if layout.layout_id not in manifest.compiled:
        manifest.compiled[layout.layout_id] = _CompiledLayout(layout, _record(), F.col("_tail"))
    return manifest.compiled[layout.layout_id]


def decode_payload(manifest: Manifest, tasks=None, table_driven: bool | str | None = None):
    """Add ``payload``, ``record_parse_error`` and ``field_parse_error``.

    Rows whose event kind is unknown keep an empty payload and are flagged. ``tasks``
    (upper case) keeps rows of those tasks and unknown ones, and decodes only their
    layouts; ``table_driven`` forces that path (``True``) or the fold (``"fold"``) for all layouts.
    """

    def apply(df: DataFrame) -> DataFrame:
        df = attach_manifest(manifest)(df)
        if tasks is not None:
            name = F.upper(F.regexp_replace(F.coalesce("TaskName", "ProviderName"), r"^\s+|\s+$", ""))
            df = df.where(F.col("manifest_missing") | name.isin(*tasks))
        wanted = [
            x for x in manifest.layouts
            if tasks is None or (x.task_name or "").strip().upper() in tasks
        ]
        in_code = frozenset() if table_driven else manifest.compiled_ids(wanted)
        by_table = [x for x in wanted if x.layout_id not in in_code]
        compiled = [x for x in wanted if x not in by_table]

        columns = df.columns
        properties = {x.layout_id: _property_rows(x) for x in by_table}
        by_cursor = {} if table_driven == "fold" else {i: p for i, p in properties.items() if cursor.placeable(p)}
        if by_table:
            rows = local_table(
                manifest.spark,
                [(i, i in by_cursor, p) for i, p in properties.items()],
                PROPERTY_ROWS,
            )
            # Same bound as the manifest itself: its property rows, grouped.
            df = df.join(F.broadcast(rows), "layout_id", "left")

        df = df.withColumns(
            {
                "_size": F.coalesce(F.length("UserData"), F.lit(0)).cast("bigint"),
                "_pointer": F.when(
                    F.col("Flags").bitwiseAND(F.lit(C.FLAG_32_BIT_HEADER)) != 0, 4
                ).otherwise(8),
            }
        )
        some = F.col("_size") > 0
        layouts = [(x.layout_id, _compiled(manifest, x)) for x in compiled]
        staged = {}
        ways = []
        if len(by_cursor) < len(by_table):
            staged["_folded"] = F.when(some & ~F.col("_by_cursor"), _fold_expression())
            ways.append("_folded")
        if by_cursor:
            visible(df.sparkSession)
            # Payloads of other layouts do not travel to the cursor.
            own = F.when(some & F.col("_by_cursor"), F.col("UserData"))
            df = df.withColumn("_places", cursor.places(by_cursor)(own, F.col("layout_id"), F.col("_pointer")))
            kinds = fields.Kinds.of(p for rows_ in by_cursor.values() for p in rows_)
            staged["_placed"] = F.when(some & F.col("_by_cursor"), _placed_expression(kinds))
            ways.append("_placed")
        tails = [(layout_id, x.tail) for layout_id, x in layouts if x.tail is not None]
        if tails:
            staged["_tail"] = F.when(some, _by_layout(tails))
        if staged:
            df = df.withColumns(staged)

        def merged(part: str, default: Column) -> Column:
            out = []
            if layouts:
                chosen = _by_layout([(i, getattr(x, part)) for i, x in layouts])
                out.append(F.when(some, chosen))
            out += [F.col(way)[part] for way in ways]
            return F.coalesce(*out, default) if out else default

        # A lambda keeps this projection out of whole-stage code. All layouts in one
        # method would be too long for the JIT; a projection of its own is split up.
        unknown = F.exists(F.array(F.col("manifest_missing")), lambda x: x)
        no = F.lit(False)
        return df.select(
            *columns,
            merged("payload", _empty_payload()).alias("payload"),
            (unknown | merged("bad", no)).alias("record_parse_error"),
            merged("missing", no).alias("field_parse_error"),
        )

    return apply


def event_view(task: str, fields_: dict[str, str]):
    """Typed columns of one task: ``{field: SQL type}`` over decoded events.

    Text that does not fit the type gives NULL, as fields that look numeric may hold
    words.
    """

    def apply(df: DataFrame) -> DataFrame:
        return df.where(F.col("task_name") == task).select(
            "record_id",
            *[_typed(F.col("payload")[name], kind).alias(name) for name, kind in fields_.items()],
        )

    return apply


def _typed(value: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.when(value.isNotNull(), F.lower(value).isin("1", "true"))
    if kind == "timestamp":
        return F.try_to_timestamp(value)
    if kind == "hex":
        return F.when(
            value.rlike("^0[xX][0-9A-Fa-f]{1,16}$"),
            F.conv(F.substring(value, 3, 16), 16, 10).cast("decimal(20,0)"),
        )
    return value.try_cast(kind)


# Out-types of the converter table to the SQL types of a typed view.
_VIEW_TYPES = {
    **dict.fromkeys(C.OUT_TO_INT, "decimal(20,0)"),
    **dict.fromkeys(C.OUT_TO_FLOAT, "double"),
    C.OUT_BOOLEAN: "boolean",
}


def declared_fields(manifest: Manifest, task: str) -> dict[str, str]:
    """Field -> SQL type of a task, by the manifest's out-types."""
    out: dict[str, str] = {}
    for layout in manifest.layouts:
        if (layout.task_name or "").strip().upper() != task:
            continue
        for p in layout.top:
            if p.out_type != C.OUT_NOPRINT:
                out[p.name] = _VIEW_TYPES.get(p.out_type, "string")
    return out
