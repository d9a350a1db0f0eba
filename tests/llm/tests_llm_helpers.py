"""Brute-force versions that the pipeline's test shares with the operators' tests."""

import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).parent))

from test_line_runs import brute as repeated_lines  # noqa: E402, F401
from test_ngram_trie import brute as near_groups  # noqa: E402, F401
from test_packing import check_pieces  # noqa: E402, F401
from test_spaced_seeds import contained, words  # noqa: E402, F401
