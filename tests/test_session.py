"""Session helpers: shared scratch space, sizinging."""

from scorewell.session import checkpoint_dir, cluster_conf, scratch_path


def test_checkpoint_dir_follows_session_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    assert got
    if configured:  # a configured shared folder is used, never replaced
        assert configured.rstrip("/").split(":")[-1] in got
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(got.rstrip("/"))


def test_cluster_conf_sizes_partitions():
    tb = 100 * (1 << 40)
    conf = cluster_conf(tb, cores=4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == tb // (256 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1 << 20, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
