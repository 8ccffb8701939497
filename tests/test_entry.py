"""The text operators are an addition: all else works without them."""

import os
import shutil
import subprocess
import sys

from rushcart.plans import PLANS

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..")


def test_the_rest_imports_without_the_text_operators(tmp_path):
    shutil.copytree(os.path.join(ROOT, "rushcart"), tmp_path / "rushcart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op')])"],
        cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True,
    )
    assert said.returncode == 0, said.stderr
    assert said.stdout.split() == [str(len(PLANS)), "[]"]


def test_a_broken_text_operator_is_not_passed_over(tmp_path):
    shutil.copytree(os.path.join(ROOT, "rushcart"), tmp_path / "rushcart", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if not os.path.exists(os.path.join(ROOT, name)):
            return  # nothing to break without them
        shutil.copy(os.path.join(ROOT, name), tmp_path)
    if not (tmp_path / "rushcart" / "llm").exists():
        return
    (tmp_path / "rushcart" / "llm" / "queries.py").write_text("import no_such_module\n")
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert said.returncode != 0 and "no_such_module" in said.stderr


def test_nothing_else_imports_the_text_operators():
    for folder, _, files in os.walk(os.path.join(ROOT, "rushcart")):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "rushcart.llm" not in f.read(), name
