"""Launcher for spark-submit: ``spark-submit --py-files aerostage.zip tools/daily_submit.py run ...``."""

import sys

from aerostage.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
