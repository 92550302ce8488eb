"""Python workers need no copy of the package."""

import subprocess
import sys
import textwrap

from conftest import ROOT, SF


def test_tasks_run_without_the_package_on_their_path(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(
        textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        import __spark_entry__ as entry_point
        from scoreloom import build_session
        spark = build_session("workers", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
        for name in ("batch_generate", "scan_files"):
            assert entry_point.queries()[name](spark, {SF!r}).count() > 0
        print("done")
        """)
    )
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert ran.stdout.strip().endswith("done"), ran.stderr[-2000:]
