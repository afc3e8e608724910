"""The package is not on the executors' path; an unset checkpoint folder is an error on a cluster."""

import os
import subprocess
import sys

import pytest

from tagwise import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_entry_runs_from_another_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as e\nsys.path.remove(sys.path[0])\n"
            "from tagwise.session import build_session\n"
            "s = build_session('local[4]', 4, extra={'spark.ui.showConsoleProgress': 'false'})\n"
            "print('ROWS', e.entry(s).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 4000" in out.stdout, out.stderr[-2000:]


def test_no_scratch_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Opt:
        def isDefined(self):
            return False

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Opt()})()})()

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
