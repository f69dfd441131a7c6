"""Window length and stride by pattern length.

A text is sampled with windows of ``q`` bytes at every offset divisible by the
stride ``s``.  An occurrence of a pattern with at least ``q + s - 1`` bytes holds
at least one such window whole, so the pattern can be found by that window.
Shorter patterns take smaller windows and strides.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class WindowClass:
    q: int
    stride: int
    least: int | None = None  # length from which patterns take the class, if not the shortest that can

    @property
    def min_len(self) -> int:
        return self.least or self.q + self.stride - 1

    def with_stride_up_to(self, most: int) -> WindowClass:
        """The same windows for the same patterns, taken more often."""
        return self if self.stride <= most else WindowClass(self.q, most, self.min_len)


# For patterns too short for a stride of 8.  Windows this small are rarely
# selective, so they take most of the pattern and a small stride.
SHORT_CLASSES = [WindowClass(6, 2), WindowClass(3, 1), WindowClass(2, 1), WindowClass(1, 1)]


def window_classes(q: int = 32, stride: int = 32) -> list[WindowClass]:
    """The class for long patterns first, then halved ones, then the short ones."""
    if q < 1 or stride < 1:
        raise ValueError("q and stride must be at least 1")
    classes = [WindowClass(q, stride)]
    while classes[-1].stride >= 16:
        classes.append(WindowClass(max(1, classes[-1].q // 2), classes[-1].stride // 2))
    return classes + [c for c in SHORT_CLASSES if c.min_len < classes[-1].min_len]
