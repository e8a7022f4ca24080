import __spark_entry__ as e


def test_names_agree():
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 50
