"""Hand-made messages for the boundary tests (fixed ids, explicit publish times)."""

from __future__ import annotations

import datetime as dt
import json

from eventwatch.schema import MESSAGE

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def ts(ms: int) -> dt.datetime:
    return EPOCH + dt.timedelta(milliseconds=ms)


def payload(src="1.1.1.1", dst="2.2.2.2", port=80, sent=20, received=30, process="process1", user="user1",
            request_ms=0) -> str:
    """A proxy message as JSON; the user key is left out when None."""
    fields = {"source_ip": src, "destination_ip": dst, "destination_port": port, "process": process, "user": user,
              "bytes_sent": sent, "bytes_received": received, "request_timestamp": request_ms}
    return json.dumps({k: v for k, v in fields.items() if v is not None})


def messages(spark, rows):
    """rows: (payload str|bytes, message_id, publish_ms[, attributes])."""
    data = []
    for r in rows:
        p = r[0].encode() if isinstance(r[0], str) else r[0]
        attrs = r[3] if len(r) > 3 else None
        data.append((bytearray(p), attrs, r[1], ts(r[2])))
    return spark.createDataFrame(data, MESSAGE)
