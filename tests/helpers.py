"""Small hand-made manifests and records."""

from traceframe import schema
from traceframe.operators.decode import decode_payload
from traceframe.operators.manifest import Manifest

PROVIDER = "{11111111-2222-3333-4444-555555555555}"


def prop(name, in_type=0, out_type=0, **more):
    return {"name": name, "in_type": in_type, "out_type": out_type, **more}


def layout(spark, props, maps=()):
    rows = [
        (
            PROVIDER, 1, 0, i, p["name"], p.get("flags", 0), p["in_type"], p["out_type"],
            p.get("map_name"), p.get("count", 1), p.get("count_index"), p.get("length", 0),
            p.get("length_index"), p.get("struct_start"), p.get("struct_members"),
            p.get("top_level", True),
        )
        for i, p in enumerate(props)
    ]
    return Manifest.of(spark, [(PROVIDER, 1, 0, "Provider", "Task", None, 0)], rows, maps)


def records(spark, payloads, items=None, **header):
    rows = []
    for i, data in enumerate(payloads):
        row = {
            "record_id": i, "is_kernel": False, "Size": 0, "HeaderType": 0, "Flags": 0x40,
            "EventProperty": 0, "ThreadId": 0, "ProcessId": 4, "TimeStamp": i,
            "ProviderId": PROVIDER, "Id": 1, "Version": 0, "Channel": 0, "Level": 4, "Opcode": 0,
            "Task": 0, "Keyword": 0, "KernelTime": 0, "UserTime": 0, "ActivityId": PROVIDER,
            "ExtendedData": items or [], "UserData": bytearray(data),
        }
        row.update(header)
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, schema.RAW_EVENTS)


def decode(spark, props, data, by_table=None, maps=()):
    manifest = layout(spark, props, maps)
    return records(spark, [data]).transform(decode_payload(manifest, table_driven=by_table)).first()
