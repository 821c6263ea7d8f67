"""Files of n events."""

from tracefold.sources import tables as K


def test_small_files_have_no_file_beside_them(spark, tmp_path):
    for path in (str(tmp_path / "a"), f"file://{tmp_path}/b"):
        K.split_by_count(spark.range(95).coalesce(1), path, 20)
        K.split_by_count(spark.range(5).coalesce(1), path, 20)
        assert spark.read.parquet(path).count() == 100
    for name in ("a", "b"):
        assert len(list((tmp_path / name).glob("part-*.parquet"))) == 6
        assert not list((tmp_path / name).glob(".part-*.crc"))
