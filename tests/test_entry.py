import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parent.parent


def test_flagship_runs(spark):
    out = __spark_entry__.entry(spark)
    assert out.columns == ["seq", "brand", "brand_inferred", "brand_confidence", "confidence_level"] and out.count() == 200


def test_each_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_optional_subpackage():
    code = (
        "import sys\n"
        "class Block:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('lodestar.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Block())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert e.catalog.FLAGSHIP in names and not any(n.startswith('op1_') or n == 'pipeline' for n in names)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def copy_of_the_repository(folder):
    shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    return folder


def test_a_copy_without_the_subpackage(tmp_path):
    """What the optional parts leave behind imports, and its tests are found."""
    copy = copy_of_the_repository(tmp_path / "copy")
    shutil.rmtree(copy / "lodestar" / "llm", ignore_errors=True)
    shutil.rmtree(copy / "tests" / "llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e, bench\nassert e.catalog.FLAGSHIP in e.queries() and set(e.oracle_sql()) <= set(e.queries()) and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
    subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, check=True, stdout=subprocess.DEVNULL)


def test_errors_inside_the_optional_parts_are_told(tmp_path):
    copy = copy_of_the_repository(tmp_path / "copy")
    if not (copy / "lodestar" / "llm" / "queries.py").exists():
        return
    (copy / "lodestar" / "llm" / "queries.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True)
    assert done.returncode and "no_such_module" in done.stderr
