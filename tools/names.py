"""Print the query names registered by one catalog module."""

import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from runlens.plans import catalog  # noqa: F401
from runlens.plans.catalog.registry import QUERIES

print(" ".join(k for k, v in QUERIES.items() if v.__module__.endswith(sys.argv[1])))
