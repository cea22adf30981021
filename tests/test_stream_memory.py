"""Parts of a source and channel in order, without holding them as Python objects."""

import random
import tracemalloc

import pandas as pd

from seatracks.streaming import nm4


def frames(n, size=10_000):
    order = list(range(n))
    random.Random(1).shuffle(order)
    for k in range(0, n, size):
        part = order[k : k + size]
        yield pd.DataFrame({"path": [f"f{i % 3}" for i in part], "line_no": part, "sentence": [f"!AIVDM,2,1,5,A,{i:060d},0*00" for i in part], "payload": [f"{i:060d}" for i in part], "pad": 0, "date": "20240101T000000.000Z", "fragments": 2, "fragment": 1})


def test_parts_in_order():
    got = list(nm4._in_order(frames(25_000, 7_000)))
    assert [(r.path, r.line_no) for r in got] == sorted((f"f{i % 3}", i) for i in range(25_000))
    assert all(r.payload == f"{r.line_no:060d}" and r.fragment == 1 for r in got) and list(nm4._in_order(iter([]))) == []


def test_memory_of_objects_is_bounded():
    """Python objects alive at a time, as tracemalloc sees them, don't grow with the parts."""
    def peak(n):
        tracemalloc.start()
        for _ in nm4._in_order(frames(n)):
            pass
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top

    assert peak(120_000) < 2.5 * peak(30_000)
