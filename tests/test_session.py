import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_scratch_without_checkpoint_dir_config(tmp_path):
    """With spark.checkpoint.dir unset, a local session still gets one stable scratch root."""
    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    code = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        from larkspur.session import shared_dir, scratch_path, drop_scratch
        assert spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
        a, b = shared_dir(spark), shared_dir(spark)
        assert a == b and scratch_path(spark, "x").startswith(a)
        p = scratch_path(spark, "x"); spark.range(3).write.parquet(p)
        assert spark.read.parquet(p).count() == 3
        drop_scratch(spark)
        print("OK")
    """)
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-2000:]
