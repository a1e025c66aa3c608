import os
import subprocess
import sys
import textwrap
import time

import pytest

from gridspark import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_clean_takes_old_scratch_folders_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    old, _ = (session.materialise(spark.range(3), name).inputFiles()[0] for name in ("old", "new-one"))
    (tmp_path / "somebody-elses").mkdir()
    age = time.time() - 7200
    for name in (os.path.dirname(old.removeprefix("file://")), tmp_path / "somebody-elses"):
        os.utime(name, (age, age))
    assert session.clean(spark, 1) == 1
    assert sorted(n.name.split("-")[0] for n in tmp_path.iterdir()) == ["new", "somebody"]
    assert session.clean(spark, -1) == 1


def test_a_local_session_remembers_its_scratch_folder(spark, monkeypatch):
    class Bare:
        class conf:
            get = staticmethod(lambda *_: None)

        sparkContext = spark.sparkContext

    monkeypatch.setattr(session, "_LOCAL_ROOTS", {})
    root = session.scratch_root(Bare)
    assert os.path.isdir(root) and session.scratch_root(Bare) == root


@pytest.mark.parametrize("missing", ["xxhash", "gridspark.llm", "corpus_pipeline"])
def test_entry_works_without_the_optional_part(missing):
    script = f"""
        import sys
        sys.modules[{missing!r}] = None
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as entry
        assert "quality_report" in entry.queries() and "quality_report" in entry.oracle_sql()
        assert not [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
