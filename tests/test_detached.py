"""The library without its training-data operators and their pipeline."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*sorted(e.queries()))"


def listed(folder, *before: str) -> set[str]:
    done = subprocess.run(
        [sys.executable, "-c", "; ".join([*before, LIST])], cwd=folder, capture_output=True, text=True, check=True,
        env={**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"},
    )
    return set(done.stdout.split())


def training(key: str) -> bool:
    return key == "pipeline" or (key.startswith("op") and key[2].isdigit())


@pytest.mark.parametrize("gone", [("corridor/llm", "tests/llm"), ("corridor/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_without_the_folders(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda at, names: [
        n for n in names if n.startswith(".") or n == "__pycache__" or os.path.relpath(os.path.join(at, n), ROOT) in gone
    ])
    here, there = listed(ROOT), listed(copy)
    assert there == {key for key in here if not training(key)} and len(there) > 100
    collected = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"],
        cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONDONTWRITEBYTECODE": "1"},
    )
    assert collected.returncode == 0, collected.stdout[-2000:]


def test_the_rest_without_a_library_only_they_need():
    missing = listed(ROOT, "import sys", "sys.modules['zstandard'] = None", "sys.modules['tokenizers'] = None",
                     "sys.modules['public_tokenizers'] = None")
    assert {key for key in missing if not training(key)} == {key for key in listed(ROOT) if not training(key)}


def test_nothing_else_imports_the_folder():
    inside = os.path.join(ROOT, "corridor", "llm")
    for at, _, names in os.walk(os.path.join(ROOT, "corridor")):
        for name in names:
            if name.endswith(".py") and not at.startswith(inside):
                with open(os.path.join(at, name)) as file:
                    assert "corridor.llm" not in file.read(), name
