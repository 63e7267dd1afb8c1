import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), len(o), 'pipeline' in q)"


def listed(where):
    run = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=where, env=os.environ | {"PYTHONPATH": where}, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_queries_are_listed_without_a_session():
    assert int(listed(ROOT)[0]) >= 92


def test_library_stands_without_the_training_data_folders(tmp_path):
    for name in ("amalgam", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    assert listed(str(tmp_path)) == ["126", "123", "False"]


def test_entry(spark):
    import __spark_entry__

    frame = __spark_entry__.entry(spark)
    assert frame.columns == ["p_partkey", "p_name", "flag_consensus"] and frame.count() == 200
