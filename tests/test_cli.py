import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_lists_every_feed():
    out = subprocess.run([sys.executable, "-m", "relcast", "feeds"], cwd=ROOT, capture_output=True, text=True,
                         timeout=120, check=True).stdout.splitlines()
    assert len(out) == 38
    names = {line.split()[0] for line in out}
    assert {"mupdme", "pc_hospital_owner", "optout", "covid19nursinghomes", "betos"} <= names
