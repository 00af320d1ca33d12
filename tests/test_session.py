from millrace.session import _CLEANUP, brief_shuffles, stage, staging_scope


def test_scope_deletes_all_but_what_is_staged_around_it(spark):
    frame = spark.range(1000).groupBy("id").count()
    with staging_scope(spark) as around:
        inner = stage(frame, "inner")
        kept = stage(inner, "kept", around)
    assert kept.count() == 1000
    assert "scope-" in inner.inputFiles()[0] and "scope-" not in kept.inputFiles()[0]


def test_staging_leaves_the_setting_and_the_frame_usable(spark):
    before = spark.conf.get(_CLEANUP)
    frame = spark.range(1000).groupBy("id").count()
    first = stage(frame, "first")
    assert spark.conf.get(_CLEANUP) == before
    assert frame.count() == stage(frame, "again").count() == first.count() == 1000
    try:
        with brief_shuffles(spark):
            raise ValueError
    except ValueError:
        assert spark.conf.get(_CLEANUP) == before
