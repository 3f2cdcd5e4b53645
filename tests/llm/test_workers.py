"""All operators on workers that cannot import the package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__
from quillmark.llm import catalogue
from quillmark.session import local_session

spark = local_session("elsewhere", 4)

def absent(batches):
    import importlib.util
    import sys
    assert importlib.util.find_spec("quillmark") is None, sys.path
    yield from batches

spark.range(1).mapInArrow(absent, "id long").collect()
for name, query in {{**catalogue.all_queries(), "pipeline": __spark_entry__.queries()["pipeline"]}}.items():
    query(spark, {sf!r}).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""

SAME = """
import sys
sys.path.insert(0, {repo!r})
from quillmark.session import local_session

print("ran", local_session("same", 2).range(3).mapInArrow(lambda batches: batches, "id long").count())
"""


def test_workers_without_the_package(folder, sf_dir):
    repo = str(Path(__file__).parents[2])
    script = Path(folder, "elsewhere.py")
    script.write_text(SCRIPT.format(repo=repo, sf=sf_dir))
    done = subprocess.run([sys.executable, str(script)], cwd=folder, env={"PATH": "/usr/local/bin:/usr/bin:/bin", **_java()}, capture_output=True, text=True, timeout=900)
    from quillmark.llm import catalogue

    assert done.stdout.count("ran ") == len(catalogue.all_queries()) + 1, done.stdout[-500:] + done.stderr[-3000:]


def test_workers_run_the_same_python(folder):
    repo = str(Path(__file__).parents[2])
    other = Path(folder, "bin", "python3")
    other.parent.mkdir()
    other.write_text("#!/bin/sh\nexit 1\n")
    other.chmod(0o755)
    script = Path(folder, "same.py")
    script.write_text(SAME.format(repo=repo))
    done = subprocess.run([sys.executable, str(script)], cwd=folder, env={"PATH": f"{other.parent}:/usr/local/bin:/usr/bin:/bin", **_java()}, capture_output=True, text=True, timeout=300)
    assert "ran 3" in done.stdout, done.stdout[-500:] + done.stderr[-3000:]


def _java() -> dict:
    import os

    return {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "SPARK_HOME", "HOME")}
