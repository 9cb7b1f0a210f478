"""Text sources and validation rules."""

import ipaddress

from pyspark.sql import functions as F

from traceframe.operators import validate as v
from traceframe.sources.text import read_event_dump, read_field_catalog

DUMP = """WININET_READDATA
Request: 0x441F10
Size: 573

WININET_AUTOPROXY_PERFTRACK_HOST_IP_LOOKUP

WININET_DNS_QUERY
_HostNameLength: 13
HostName: www.gmail.com
RequestHandle: 0xCC000C
_AddressListLength: 15
AddressList: 216.58.218.133;

WININET_USAGELOGREQUEST
URL: http://www.gmail.com/
Verb: GET
RequestHeaders: GET / HTTP/1.1
User-Agent: TestAgent
Date: Fri, 10 Feb 2017 09:46:05 GMT
Date: again
ProxyList:
no colon here
"""

CATALOG = "WININET_READDATASTOP\n\t- Request\n\t- Size\n\t- Spare\n\nWININET_DNS_QUERYSTART\n\t- HostName\n"


def dump(spark, tmp_path, text=DUMP):
    path = tmp_path / "dump.txt"
    path.write_text(text)
    return read_event_dump(spark, str(path))


def test_event_dump(spark, tmp_path):
    events = {r.task_name: r.payload for r in dump(spark, tmp_path).collect()}
    assert len(events) == 4
    assert events["WININET_READDATA"] == {"Request": "0x441F10", "Size": "573"}
    assert events["WININET_AUTOPROXY_PERFTRACK_HOST_IP_LOOKUP"] == {}
    log = events["WININET_USAGELOGREQUEST"]
    assert log["URL"] == "http://www.gmail.com/" and log["User-Agent"] == "TestAgent"
    assert log["Date"] == "again" and log["ProxyList"] == "" and log["no colon here"] is None


def test_header_lines_belong_to_their_field(spark, tmp_path):
    text = DUMP.replace("ProxyList:\n", "ResponseHeaders: HTTP/1.1 301\nStatus-Line: x\n_Hidden: 7\nStatus: 5\nOther: 6\nResponseHeaders: again\n")
    fields = ["URL", "Verb", "RequestHeaders", "ResponseHeaders", "Status"]
    names = [("WININET_USAGELOGREQUESTSTART", f) for f in fields] + [("WININET_DNS_QUERYSTART", "HostName")]
    catalog = spark.createDataFrame(names, "task string, field string")
    path = tmp_path / "headers.txt"
    path.write_text(text)
    events = {r.task_name: r.payload for r in read_event_dump(spark, str(path), catalog=catalog).collect()}
    plain = {r.task_name: r.payload for r in dump(spark, tmp_path, text).collect()}
    assert events["WININET_USAGELOGREQUEST"] == {
        "URL": "http://www.gmail.com/", "Verb": "GET",
        "RequestHeaders": "GET / HTTP/1.1\nUser-Agent: TestAgent\nDate: Fri, 10 Feb 2017 09:46:05 GMT\nDate: again",
        "_Hidden": "7", "Status": "5", "Other": "6", "ResponseHeaders": "again\nno colon here",
    }
    # Tasks without headers, and tasks that the catalog does not list, are read as before.
    del events["WININET_USAGELOGREQUEST"], plain["WININET_USAGELOGREQUEST"]
    assert events == plain and len(events) == 3
    none = read_event_dump(spark, str(path), catalog=catalog.limit(0)).where("task_name = 'WININET_USAGELOGREQUEST'").first()
    assert none.payload["User-Agent"] == "TestAgent"


def test_event_dump_with_carriage_returns(spark, tmp_path):
    path = tmp_path / "crlf.txt"
    path.write_bytes(b"TASK\r\nA: 1\r\n\n\n\nOTHER\r\nB: 2\r\n")
    rows = {r.task_name: r.payload for r in read_event_dump(spark, str(path)).collect()}
    assert rows == {"TASK": {"A": "1"}, "OTHER": {"B": "2"}}


def test_catalog(spark, tmp_path):
    path = tmp_path / "catalog.txt"
    path.write_text(CATALOG)
    catalog = read_field_catalog(spark, str(path))
    rows = [tuple(r) for r in catalog.orderBy("task", "ordinal").collect()]
    assert rows == [
        ("WININET_DNS_QUERYSTART", 0, "HostName"), ("WININET_READDATASTOP", 0, "Request"),
        ("WININET_READDATASTOP", 1, "Size"), ("WININET_READDATASTOP", 2, "Spare"),
    ]
    found = dump(spark, tmp_path).transform(v.catalog_conformance(catalog)).collect()
    assert {tuple(r) for r in found} == {
        ("WININET_READDATA", "Spare", "not_seen"), ("WININET_DNS_QUERY", "_HostNameLength", "not_in_catalog"),
        ("WININET_DNS_QUERY", "RequestHandle", "not_in_catalog"),
        ("WININET_DNS_QUERY", "_AddressListLength", "not_in_catalog"),
        ("WININET_DNS_QUERY", "AddressList", "not_in_catalog"),
    }


def test_standard_rules_on_a_dump(spark, tmp_path):
    events = dump(spark, tmp_path).withColumn("EventExtendedData", F.lit(None).cast("string"))
    report = {(r.task, r.rule): (r.checked, r.failed) for r in events.transform(v.validate(v.standard_rules())).collect()}
    assert len(report) == len(v.standard_rules())
    assert report["WININET_READDATA", "field_count"] == (1, 0)
    assert report["WININET_DNS_QUERY", "address_list:AddressList"] == (1, 0)
    assert report["WININET_DNS_QUERY", "length:AddressList"] == (1, 0)
    assert report["WININET_USAGELOGREQUEST", "headers_when_long"] == (1, 1)
    assert report["THREADSTART", "required_fields"] == (0, 0)


def test_more_rules_than_fit_one_word(spark):
    df = spark.createDataFrame([("T", {f"F{i}": str(i) for i in range(70)}, None)] * 3, "task_name string, payload map<string,string>, EventExtendedData string")
    rules = [v.number_between("T", f"F{i}", 0, 35) for i in range(70)]
    report = {r.rule: (r.checked, r.failed) for r in df.transform(v.validate(rules)).collect()}
    assert all(report[f"between:F{i}"] == (3, 0 if i <= 35 else 3) for i in range(70))


def test_addresses_agree_with_the_standard_library(spark):
    texts = [
        "1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "01.2.3.4", "1.2.3.4.5", "", "::", "::1", "1::",
        "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1::2::3", "fe80::1%eth0", "12345::",
        "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "::1.2.3.256", "g::1", ":1", "1:", "1:2:3:4:5:6:7", "abc", "1::2:3:4:5:6:7:8", "0::0:0:0:0:0:0",
    ]

    def valid(text):
        try:
            ipaddress.ip_address(text)
        except ValueError:
            return False
        return True

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.ok for r in df.select("t", v.is_ip(F.col("t")).alias("ok")).collect()}
    assert got == {t: valid(t) for t in texts}


def test_variants_and_addresses(spark):
    def event(i, task, **payload):
        return (i, task, payload, None)

    rows = [
        event(0, "WININET_CONNECT", Request="0x1"),
        event(1, "WININET_CONNECT", Socket="80"),
        event(2, "WININET_CONNECT", Request="0x1", RemoteAddressLength="16", RemoteAddress="10.0.0.1:99999"),
        event(3, "WININET_CONNECT", Socket="80", Protocol="x", LocalAddressLength="0", LocalAddress="", RemoteAddressLength="16",
              RemoteAddress="10.0.0.1:443"),
        event(4, "WININET_DNS_QUERY", a="1", b="2", c="3", Error="5"),
        event(5, "WININET_DNS_QUERY", a="1", b="2", c="3", d="5"),
        event(6, "WININET_DNS_QUERY", a="1", b="2", c="3", _AddressListLength="1", AddressList=";"),
        event(7, "WININET_DNS_QUERY", a="1", b="2", c="3", d="1", e=";"),
        event(8, "WININET_HTTP_RESPONSE", ContentLength="-1"),
    ]
    df = spark.createDataFrame(rows, "record_id long, task_name string, payload map<string,string>, EventExtendedData string")
    report = {(r.task, r.rule): (r.checked, r.failed) for r in df.transform(v.validate(v.standard_rules())).collect()}
    assert report["WININET_CONNECT", "required_fields_of_variant"] == (4, 2)
    assert report["WININET_CONNECT", "address:RemoteAddress"] == (2, 1)
    assert report["WININET_CONNECT", "address_port:LocalAddress"] == (0, 0)
    assert report["WININET_DNS_QUERY", "required_fields_of_variant"] == (4, 2)
    assert report["WININET_HTTP_RESPONSE", "between:ContentLength"] == (1, 1)


def test_blocks_of_windows_files(spark, tmp_path):
    text = "task_a\r\nX: 1\r\n\r\ntask_b\r\nX: 2\r\n \r\ntask_c\r\nX: 3\r\n"
    (tmp_path / "dump.txt").write_bytes(text.encode())
    for separator in ("\r\n\r\n", "\n\n"):
        rows = read_event_dump(spark, str(tmp_path / "dump.txt"), separator).collect()
        assert sorted((r.task_name, r.payload["X"]) for r in rows) == [("TASK_A", "1"), ("TASK_B", "2"), ("TASK_C", "3")]
