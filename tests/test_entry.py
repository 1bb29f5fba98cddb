"""The entry without its optional part."""

import subprocess
import sys

ENTRY = """
import sys
for name in {missing}:
    sys.modules[name] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert "site_score" in names and set(entry.oracle_sql()) <= names
print(sorted(n for n in names if n == "pipeline" or n.startswith("op")))
"""


def found(missing):
    run = subprocess.run(
        [sys.executable, "-c", ENTRY.format(missing=missing)], capture_output=True, text=True, check=True,
        cwd=__file__.rsplit("/", 2)[0],
    )
    return run.stdout.strip()


def test_queries_without_what_the_optional_part_needs():
    assert found(["sitewind.llm"]) == found(["duckdb"]) == found(["tokenizers"]) == "[]"
    assert found(["sitewind.llm", "corpus_pipeline"]) == "[]"
