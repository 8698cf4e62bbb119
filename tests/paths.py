"""Places that several test modules need."""

from pathlib import Path

FIXTURE_DIR = Path(__file__).resolve().parent / "fixtures"
