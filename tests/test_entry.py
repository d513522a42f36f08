"""The entry points without the part for training data."""

import subprocess
import sys
from pathlib import Path


def test_the_rest_works_without_the_subpackage():
    code = (
        "import sys; sys.modules['landfall.llm'] = None\n"
        "import __spark_entry__ as e\n"
        "assert 'merge_upsert' in e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], check=True, timeout=120)
