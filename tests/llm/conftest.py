import os
import sys

sys.path.insert(0, os.path.dirname(__file__))

from fixtures import clashing, edge, empty  # noqa: E402, F401
