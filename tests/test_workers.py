import os
import subprocess
import sys

from pyspark import cloudpickle

from ohmstead.operators import boost


def test_worker_code_needs_no_installed_package(tmp_path):
    path = tmp_path / "fold.bin"
    path.write_bytes(cloudpickle.dumps(boost.Binning(["k"], ["v"], [[1.0, 2.0]], [{"a": 1}])))
    code = "import pickle, sys; b = pickle.load(open(sys.argv[1], 'rb')); print(b.codes([['a', 'z']], 2).tolist(), b.numeric([[0.5, 3.0]], 2).tolist())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, str(path)], cwd="/", env=env, capture_output=True, text=True, timeout=60)
    assert out.stdout.strip() == "[[1, 0]] [[0, 2]]", out.stderr
