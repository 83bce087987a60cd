"""Retry with exponential backoff and jitter, for calls inside partition functions."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")


class PermanentError(Exception):
    """Not worth another try."""


def with_retry(call: Callable[[], T], attempts: int = 2, least: float = 2.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> T:
    for n in range(1, attempts + 1):
        try:
            return call()
        except PermanentError:
            raise
        except Exception:
            if n == attempts:
                raise
            sleep(random.uniform(0, min(most, least * 2 ** (n - 1))))
    raise ValueError("attempts must be positive")
