"""Building blocks: exact order statistics, distributed ranks, size-checked joins."""
