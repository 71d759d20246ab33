import pytest

from spikewatch.config import SurgeConfig


def test_defaults():
    cfg = SurgeConfig()
    assert (cfg.window_ms, cfg.slide_ms, cfg.watermark_ms, cfg.lateness_ms) == (
        15000,
        5000,
        3001,
        10000,
    )
    assert cfg.pane_ms == 5000 and not cfg.is_tumbling


@pytest.mark.parametrize(
    "bad",
    [
        {"window_seconds": 0},
        {"slide_seconds": 0},
        {"slide_seconds": 20},
        {"watermark_seconds": -1},
        {"allowed_lateness_seconds": -1},
        {"alpha": 0},
        {"alpha": 1.01},
        {"surge_threshold": 0},
        {"parallelism": 0},
        {"window_seconds": 15.5},
    ],
)
def test_rejects(bad):
    with pytest.raises(ValueError):
        SurgeConfig(**bad)


def test_options():
    cfg = SurgeConfig.from_options({"window_seconds": "30", "alpha": "0.5"})
    assert (cfg.window_seconds, cfg.alpha) == (30, 0.5)
    with pytest.raises(ValueError):
        SurgeConfig.from_options({"wndow": "1"})


def test_parallelism_sets_shuffle_width(spark):
    from spikewatch.session import configure

    before = spark.conf.get("spark.sql.shuffle.partitions")
    configure(spark, SurgeConfig(parallelism=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    spark.conf.set("spark.sql.shuffle.partitions", before)
