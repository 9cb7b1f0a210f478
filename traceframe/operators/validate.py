"""Data-quality rules over decoded events.

A rule belongs to a task and is a truth-valued column over ``payload``. The report is
one pass: the verdicts of an event's own rules are packed into a few bits, and events are
counted by task and bits. That count is made map-side first and has few groups, so a task
that holds most events is no hot spot; rules are told apart only on the counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe.operators.manifest import local_table


def value(name: str) -> Column:
    return F.col("payload")[name]


def present(name: str) -> Column:
    return F.map_contains_key("payload", name)


@dataclass(frozen=True)
class Rule:
    """``test`` is what must hold wherever ``applies`` holds; NULL counts as failed."""

    task: str
    name: str
    test: Column
    applies: Column = field(default_factory=lambda: F.lit(True))


def field_count() -> Column:
    """Fields of an event as a consumer sees them: payload, header, extended data."""
    extended = F.when(F.col("EventExtendedData").isNotNull(), 1).otherwise(0)
    return F.size("payload") + 1 + extended


def required_fields(task: str, fields) -> Rule:
    names = F.array(*[F.lit(f) for f in fields])
    return Rule(task, "required_fields", F.size(F.array_except(names, F.map_keys("payload"))) == 0)


def count_between(task: str, low: int, high: int | None = None) -> Rule:
    """Field count within bounds, both inclusive; no upper bound when ``high`` is None."""
    test = field_count() >= low
    if high is not None:
        test = test & (field_count() <= high)
    return Rule(task, "field_count", test)


def http_status(task: str, name: str) -> Rule:
    known = value(name).try_cast("int").isin(*C.HTTP_STATUS_CODES)
    return Rule(task, f"http_status:{name}", known, present(name))


def http_verb(task: str, name: str) -> Rule:
    return Rule(task, f"http_verb:{name}", value(name).isin(*C.HTTP_VERBS), present(name))


# --- addresses ------------------------------------------------------------------------

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = "[0-9A-Fa-f]{1,4}"


def _v6_pattern() -> str:
    """Eight groups, or fewer around one ``::``; the last two may be an IPv4 address."""
    forms = [f"(?:{_GROUP}:){{7}}{_GROUP}", f"(?:{_GROUP}:){{6}}{_V4}"]
    for left in range(8):
        head = f"{_GROUP}(?::{_GROUP}){{{left - 1}}}" if left else ""
        room = 7 - left
        tails = [f"(?:{_GROUP}(?::{_GROUP}){{0,{room - 1}}})?"] if room else [""]
        if room >= 2:
            tails.append(f"(?:{_GROUP}:){{0,{room - 2}}}{_V4}")
        forms.extend(f"{head}::{tail}" for tail in tails)
    return "(?:" + "|".join(forms) + ")(?:%[^%/]+)?"


_IP = f"^(?:{_V4}|{_v6_pattern()})$"


def is_ip(text: Column) -> Column:
    return text.rlike(_IP)


def is_port(text: Column) -> Column:
    return text.try_cast("int").between(0, C.MAX_PORT)


def ip_valid(task: str, name: str) -> Rule:
    return Rule(task, f"ip:{name}", is_ip(value(name)), present(name))


def port_valid(task: str, name: str) -> Rule:
    return Rule(task, f"port:{name}", is_port(value(name)), present(name))


def handle_valid(task: str, name: str) -> Rule:
    """Hex text (with or without 0x) of at most 32 bits."""
    digits = F.regexp_extract(value(name), "^(?:0[xX])?0*([0-9A-Fa-f]+)$", 1)
    return Rule(task, f"handle:{name}", F.length(digits).between(1, 8), present(name))


def length_matches(task: str, name: str, length_name: str | None = None) -> Rule:
    """The ``_XLength`` field is the length of ``X``; a missing value has length 0."""
    length_name = length_name or f"_{name}Length"
    test = F.length(F.coalesce(value(name), F.lit(""))) == value(length_name).try_cast("bigint")
    return Rule(task, f"length:{name}", test, present(length_name))


def address_port_matches(task: str, address: str, port: str) -> Rule:
    """``ip:port`` text with a valid ip whose port equals another field."""
    test = is_ip(F.regexp_replace(value(address), ":[^:]*$", "")) & (
        F.substring_index(value(address), ":", -1) == value(port)
    )
    return Rule(task, f"address_port:{address}", test, present(address) & present(port) & _has_length(address))


def address_valid(task: str, address: str) -> Rule:
    """``ip:port`` text with a valid ip and a valid port."""
    port = F.substring_index(value(address), ":", -1).try_cast("bigint")
    test = is_ip(F.regexp_replace(value(address), ":[^:]*$", "")) & port.between(0, 65535)
    return Rule(task, f"address:{address}", F.coalesce(test, F.lit(False)), present(address) & _has_length(address))


def _has_length(name: str) -> Column:
    """Whether the field's length is not 0; without a length field it is taken to have one."""
    return F.coalesce(value(f"{name}Length").try_cast("bigint") != 0, F.lit(True))


def required_of_variant(task: str, variants: dict[int | None, tuple[str, ...]]) -> Rule:
    """Fields that an event must have by the number of its fields; ``None``: any other number."""
    test = F.lit(True)
    for n, names in variants.items():
        if n is not None:
            test = test & ((field_count() != n) | all_present(names))
    if None in variants:
        numbered = [n for n in variants if n is not None]
        test = test & (field_count().isin(*numbered) | all_present(variants[None]))
    return Rule(task, "required_fields_of_variant", test)


def all_present(names) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & present(name)
    return test


def address_list(task: str, name: str) -> Rule:
    """``;``-separated addresses, every one valid."""
    entries = F.split(F.regexp_replace(value(name), ";+$", ""), ";")
    return Rule(task, f"address_list:{name}", F.forall(entries, is_ip), present(name))


def payload_bytes(task: str, length_name: str, name: str) -> Rule:
    """A byte count that is not negative, with the bytes there when it is positive."""
    count = value(length_name).try_cast("bigint")
    return Rule(
        task,
        f"payload_bytes:{name}",
        (count >= 0) & ((count == 0) | present(name)),
        present(length_name),
    )


def number_between(task: str, name: str, low: int, high: int | None) -> Rule:
    number = value(name).try_cast("bigint")
    test = number >= low
    if high is not None:
        test = test & (number <= high)
    return Rule(task, f"between:{name}", test, present(name))


def read_size(task: str, name: str) -> Rule:
    return number_between(task, name, 0, C.MAX_READ_SIZE)


# --- the report -----------------------------------------------------------------------


# Rules per BIGINT: two bits each, below the sign.
_PACK = 31
_SKIPPED, _PASSED, _FAILED = 0, 1, 2


def _packed(rules: list[Rule]) -> Column:
    """Verdicts of one task's rules: two bits each, as many BIGINTs as needed."""
    words = []
    for first in range(0, len(rules), _PACK):
        word = F.lit(0).cast("bigint")
        for i, rule in enumerate(rules[first : first + _PACK]):
            verdict = (
                F.when(~rule.applies, _SKIPPED << 2 * i)
                .when(rule.test, _PASSED << 2 * i)
                .otherwise(_FAILED << 2 * i)
            )
            word = word + verdict
        words.append(word)
    return F.array(*words)


def validate(rules: list[Rule]):
    """One row per task and rule: how many events were checked and how many failed."""
    by_task: dict[str, list[Rule]] = {}
    for rule in rules:
        by_task.setdefault(rule.task, []).append(rule)
    verdicts = None
    for task, own in sorted(by_task.items()):
        test = (F.col("task_name") == task) & F.col("payload").isNotNull()
        packed = _packed(own)
        verdicts = F.when(test, packed) if verdicts is None else verdicts.when(test, packed)
    places = [
        (task, rule.name, i // _PACK, 2 * (i % _PACK))
        for task, own in by_task.items()
        for i, rule in enumerate(own)
    ]

    def apply(df: DataFrame) -> DataFrame:
        counted = (
            df.select(F.col("task_name").alias("task"), verdicts.alias("words"))
            .groupBy("task", "words")
            .agg(F.count("*").alias("n"))
        )
        names = local_table(
            df.sparkSession, places, "task STRING, rule STRING, word INT, shift INT"
        )
        bits = F.call_function(
            "shiftright", F.get(F.col("words"), F.col("word")), F.col("shift")
        ).bitwiseAND(F.lit(3))
        return (
            names.join(counted, "task", "left")
            .withColumn("verdict", bits)
            .groupBy("task", "rule")
            .agg(
                F.coalesce(F.sum(F.when(F.col("verdict") != _SKIPPED, F.col("n"))), F.lit(0)).alias("checked"),
                F.coalesce(F.sum(F.when(F.col("verdict") == _FAILED, F.col("n"))), F.lit(0)).alias("failed"),
            )
        )

    return apply


def standard_rules() -> list[Rule]:
    """What is known to hold for web-client and process events."""
    thread = (
        "ProcessID", "StackBase", "StackLimit", "StartAddr", "SubProcessTag", "TebBase",
        "ThreadID", "UserStackBase", "UserStackLimit", "Win32StartAddr",
    )
    stop = (
        "ExitCode", "ExitTime", "HandleCount", "HardFaultCount", "ImageName", "ProcessID",
        "ReadOperationCount", "ReadTransferKiloBytes", "TokenElevationType",
        "WriteOperationCount", "WriteTransferKiloBytes",
    )
    log, read, connect = "WININET_USAGELOGREQUEST", "WININET_READDATA", "WININET_CONNECT"
    dns, response = "WININET_DNS_QUERY", "WININET_HTTP_RESPONSE"
    capture = "MICROSOFT-WINDOWS-WININET-CAPTURE"
    return [
        required_fields("THREADSTART", thread),
        count_between("THREADSTART", 11, 11),
        required_fields("THREADSTOP", thread),
        count_between("THREADSTOP", 12, 12),
        required_fields("PROCESSSTART", ("ImageName", "ParentProcessID", "ProcessID", "SessionID")),
        count_between("PROCESSSTART", 6),
        required_fields("PROCESSSTOP", stop),
        count_between("PROCESSSTOP", 16),
        count_between("PROCESS", 10),
        count_between(log, 6, 24),
        Rule(
            log,
            "headers_when_long",
            present("RequestHeaders") & present("ResponseHeaders"),
            field_count() > 6,
        ),
        http_verb(log, "Verb"),
        required_fields(read, ("Request", "Size")),
        count_between(read, 3, 3),
        handle_valid(read, "Request"),
        read_size(read, "Size"),
        count_between(connect, 2, 8),
        handle_valid(connect, "Request"),
        port_valid(connect, "Socket"),
        required_of_variant(
            connect,
            {2: ("Request",),
             None: ("Socket", "Protocol", "LocalAddressLength", "LocalAddress", "RemoteAddressLength", "RemoteAddress")},
        ),
        address_port_matches(connect, "LocalAddress", "Socket"),
        address_valid(connect, "RemoteAddress"),
        count_between(dns, 4, 6),
        required_fields(dns, ("_HostNameLength", "HostName", "RequestHandle")),
        length_matches(dns, "HostName"),
        number_between(dns, "_HostNameLength", 0, 255),
        handle_valid(dns, "RequestHandle"),
        required_of_variant(dns, {5: ("Error",), 6: ("_AddressListLength", "AddressList")}),
        length_matches(dns, "AddressList"),
        address_list(dns, "AddressList"),
        required_fields(
            response,
            ("ResponseCode", "RequestHandle", "SocketHandle", "_VerbLength", "Verb",
             "_ContentLengthStrLength", "ContentLength"),
        ),
        count_between(response, 8, 8),
        http_status(response, "ResponseCode"),
        handle_valid(response, "RequestHandle"),
        http_verb(response, "Verb"),
        length_matches(response, "Verb"),
        length_matches(response, "ContentLength", "_ContentLengthStrLength"),
        number_between(response, "ContentLength", 0, None),
        required_fields(capture, ("SessionId", "SequenceNumber", "Flags", "PayloadByteLength")),
        count_between(capture, 4, 6),
        payload_bytes(capture, "PayloadByteLength", "Payload"),
    ]


# --- catalog conformance --------------------------------------------------------------


def base_task(task: Column) -> Column:
    """Task name without its START/STOP/FAIL or number suffixes."""
    return F.regexp_replace(task, "_?(?:START|STOP|FAIL|[0-9]+)+$", "")


def catalog_conformance(catalog: DataFrame):
    """Fields that were decoded but are not in the catalog, and the reverse.

    Only tasks on both sides are compared. Pairs are made distinct first, map-side, so
    the joins see schema-sized tables.
    """

    def apply(df: DataFrame) -> DataFrame:
        seen = (
            df.select(
                base_task(F.col("task_name")).alias("task"),
                F.explode_outer(F.map_keys("payload")).alias("field"),
            )
            .where(F.col("field").isNotNull())
            .distinct()
        )
        known = catalog.select(base_task(F.col("task")).alias("task"), "field").distinct()
        pair = ["task", "field"]
        extra = seen.join(known.select("task").distinct(), "task", "left_semi").join(known, pair, "left_anti")
        unused = known.join(seen.select("task").distinct(), "task", "left_semi").join(seen, pair, "left_anti")
        return extra.withColumn("finding", F.lit("not_in_catalog")).unionByName(
            unused.withColumn("finding", F.lit("not_seen"))
        )

    return apply
