"""Entry file for ``spark-submit``, which takes a file and not a module."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stackrill.cli import main  # noqa: E402

if __name__ == "__main__":
    raise SystemExit(main())
