import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", "file://{folder}")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
spec = importlib.util.spec_from_file_location("entry", "{root}/__spark_entry__.py")
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
print("ROWS", module.queries()["drop_extremes"](spark, "{data}").count())
"""


def test_intermediate_files_go_to_the_configured_folder(tmp_path, folder):
    """Also: the entry file loads by path from any working directory."""
    script = SCRIPT.format(folder=tmp_path, root=ROOT, data=folder)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
    written = list((tmp_path / "tallyloom").iterdir())
    assert len(written) == 2 and all((d / "_SUCCESS").exists() for d in written)


def test_intermediates_are_deleted(spark, folder):
    from pathlib import Path

    from tallyloom.plans.catalogue import QUERIES
    from tallyloom.runtime import intermediates, shared_folder

    top = Path(shared_folder(spark).removeprefix("file:")) / "tallyloom"
    before = set(top.iterdir()) if top.exists() else set()
    with intermediates(spark):
        assert QUERIES["box_stats"](spark, folder).count() and len(set(top.iterdir()) - before) >= 2
    assert set(top.iterdir()) == before
