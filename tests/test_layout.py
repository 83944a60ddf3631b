"""The test folders themselves."""

from collections import Counter
from pathlib import Path


def test_no_two_test_files_share_a_name():
    """Without packages pytest imports test files by their base name, so two of one name hide each other."""
    names = Counter(p.name for p in Path(__file__).parent.rglob("test_*.py"))
    assert [n for n, c in names.items() if c > 1] == []
