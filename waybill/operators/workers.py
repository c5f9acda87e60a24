"""What all tasks of many short passes have in common."""

from __future__ import annotations

import gc

_SETTLED = False


def settle_worker() -> None:
    """Leave what this Python worker has loaded out of later garbage collections, once a worker.

    A worker collects its garbage after every task. With numpy and Arrow loaded that walks some
    80,000 objects that never go, for longer than a small pass takes. What is made later is
    collected as before.
    """
    global _SETTLED
    if not _SETTLED:
        gc.collect()
        gc.freeze()
        _SETTLED = True
