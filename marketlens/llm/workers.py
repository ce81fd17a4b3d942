"""Memory of Python workers, which live on after a task and serve the next one."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable
from typing import Any

import pyarrow as pa

# functions travel to workers by value, so that a variable of this module would not last
_MODULE = "_marketlens_kept"


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What `make` gave when this process first asked for `key`: for what takes long to load
    and what one task has learned for the next."""
    values = sys.modules.setdefault(_MODULE, types.ModuleType(_MODULE)).__dict__
    if key not in values:
        values[key] = make()
    return values[key]


def give_back() -> None:
    """Returns memory that was freed to the system; allocators hold on to it, and an
    executor's workers wait for their next task beside its JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def start_afresh() -> None:
    """Drops what tasks of other operators have kept in this process."""
    if sys.modules.pop(_MODULE, None):
        give_back()
