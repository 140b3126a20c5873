"""The entry works without the training-data subpackage, and hides no other import error."""
import os
import shutil
import subprocess
import sys

from conftest import ROOT


def _run(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {**os.environ, "PYTHONPATH": str(folder)}
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, env=env)


def _copy(tmp_path):
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(ROOT, "clickflow"), tmp_path / "clickflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))


def test_without_the_subpackage(tmp_path):
    from clickflow.plans import QUERIES
    _copy(tmp_path)
    done = _run(tmp_path)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-2]) == len(QUERIES)


def test_other_import_errors_are_raised(tmp_path):
    _copy(tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_here\n")
    done = _run(tmp_path)
    assert done.returncode != 0 and "no_such_module_here" in done.stderr


def test_without_a_package_of_the_subpackage(tmp_path):
    from clickflow.plans import QUERIES
    _copy(tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text(
        "raise ModuleNotFoundError(\"No module named 'ahocorasick'\", name='ahocorasick')\n")
    done = _run(tmp_path)
    assert done.returncode == 0 and "ahocorasick" in done.stderr
    assert int(done.stdout.split()[-2]) == len(QUERIES)
