"""The golden micro-stream: one list per micro-batch of (id, product, seconds, amount)."""

import datetime as dt
import json
import os

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

FILES = [
    [("a", "A", 1.0, 1), ("b", "A", 29.999, 2), ("c", "B", 5.0, 4)],
    [("d", "A", 39.999, 8)],
    [("e", "A", 2.0, 16)],
    [("f", "A", 40.0, 32)],
    [("g", "A", 3.0, 64), ("h", "A", 41.0, 128)],
    [("i", "A", 80.0, 256), ("j", "A", 31.0, 512)],
    [("k", "A", 4.0, 1024), ("l", "A", 61.0, 2048)],
    [("m", "A", 5.0, 4096), ("n", "A", 200.0, 1)],
]
MESSAGE = "value string, arrival bigint"
TOTALS = [
    ("a", "A", 1), ("b", "A", 3), ("c", "B", 4), ("d", "A", 11), ("f", "A", 43), ("h", "A", 171),
    ("i", "A", 427), ("n", "A", 428),
]
WINDOWS = [("A", 0, 83), ("A", 30, 680), ("A", 60, 2304), ("B", 0, 4)]


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def message(sale_id, product, seconds, amount):
    time = at(seconds).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return json.dumps(
        {
            "SalesId": sale_id,
            "ProductName": product,
            "SalesDateTime": time,
            "SalesAmount": amount,
            "EventProcessingTime": time,
        }
    )


def write_files(folder, files, first=0):
    """One JSON-lines file per micro-batch, with increasing modification times."""
    folder.mkdir(exist_ok=True)
    arrival = sum(len(f) for f in FILES[:first])
    for number, rows in enumerate(files, first):
        path = folder / f"{number:04d}.json"
        with open(path, "w") as out:
            # Written back to front: the order inside a batch must come from the arrival column.
            lines = [
                json.dumps({"value": message(*row), "arrival": arrival + i})
                for i, row in enumerate(rows)
            ]
            out.write("\n".join(reversed(lines)) + "\n")
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
        arrival += len(rows)
