"""Every stateful processor loads in a process that does not find the library."""

import base64
import subprocess
import sys
import tempfile

from pyspark import cloudpickle

from haltgate.streaming import stateful as SS

PROCESSORS = [SS.DuplicateProcessor(1, 2), SS.ThrottleProcessor(), SS.CooldownProcessor(1, 2), SS.GateProcessor(["g", "a"], ["order_id"])]


def test_processors_load_without_the_library():
    code = """
import base64, pickle, sys
try:
    import haltgate
except ModuleNotFoundError:
    haltgate = None
assert haltgate is None
for text in sys.argv[1:]:
    print(type(pickle.loads(base64.b64decode(text))).__name__)
"""
    sent = [base64.b64encode(cloudpickle.dumps(p)).decode() for p in PROCESSORS]
    done = subprocess.run([sys.executable, "-P", "-c", code, *sent], cwd=tempfile.mkdtemp(), env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == [type(p).__name__ for p in PROCESSORS]
