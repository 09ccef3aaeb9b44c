"""Distinct pieces as slices of their column."""

import pyarrow as pa

from tapewire.llm import tokens as tk


def test_byte_list_takes_slices_of_a_column(monkeypatch):
    """Pieces were made one scalar at a time, a tenth of the whole encoding."""
    column = pa.array([b"", b"a", b"\xc3\xa9 b", b"", b"c"], pa.large_binary())
    for part in (column, column.slice(1, 3), column.slice(2), column.slice(5)):
        assert tk.byte_list(part) == part.to_pylist()
