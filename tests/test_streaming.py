import json
from datetime import datetime

from test_operators import device_frame

from aforo.streaming.intake import accept_events, read_events, start_intake


def test_events_arrive_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def drop(name, *records):
        (inbox / name).write_text("".join(json.dumps(r) + "\n" for r in records))

    def event(key, device, mac, plate):
        return {"event_identifier": key, "device_source_id": device, "device_mac_address": mac,
                "date_detection": "2021-07-01 12:00:00", "vehicle_license_plate": plate}

    def run():
        stream = read_events(spark, str(inbox))
        accepted = accept_events(stream, device_frame(spark), "UTC", "America/New_York")
        start_intake(accepted, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)

    drop("a.json", event("e1", "d1", "m2", None), event("e2", "d1", "wrong", "X"))
    run()
    drop("b.json", event("e3", "d2", "m3", "AB12"))
    run()
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("event_identifier").collect()
    assert [(r.event_identifier, r.gate_id, r.vehicle_license_plate) for r in got] == [
        ("e1", 1, "Unknown"), ("e3", 3, "AB12"),
    ]
    assert got[0].date_detection == datetime(2021, 7, 1, 8)
