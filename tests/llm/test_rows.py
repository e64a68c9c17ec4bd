"""What all functions in Python share."""

import os
import re
import sys
from pathlib import Path

from tidemark.llm.rows import map_rows


def test_a_worker_gives_back_what_its_task_held(spark):
    """Workers are used again: what one stage has freed must not stay in them through the next."""

    def hold(batches):
        for (ids,) in batches:
            held = [os.urandom(2000) for _ in range(100_000)]
            # what lives on above it keeps the freed memory from going by itself
            sys.kept_by_a_test = [os.urandom(2000) for _ in range(100)]
            yield [[os.getpid()] * len(ids), [len(held)] * len(ids)]

    (row,) = map_rows(spark.range(0, 1, 1, 1), 0, "pid long, n long", hold).collect()
    assert row.n == 100_000
    now = Path(f"/proc/{row.pid}/smaps_rollup").read_text()
    assert int(re.search(r"Anonymous:\s+(\d+)", now)[1]) < 150_000  # KB
