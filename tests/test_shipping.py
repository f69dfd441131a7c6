"""Functions that run on executors travel by value, without this package."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from bytesift.operators.patterns import _profiler
from bytesift.sources.texts import _range_reader
from bytesift.streaming.across import _stitcher


@pytest.mark.parametrize("function", [_profiler(), _range_reader(), _stitcher(3, None, None, False)])
def test_loads_where_the_package_is_not(function, tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(function))
    code = "import pickle, sys; f = pickle.load(open('f', 'rb')); assert 'bytesift' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": ""}, timeout=120)
