import pytest

from folioforge.__main__ import main


def test_commands(spark, tmp_path, capsys):
    store, raw = str(tmp_path / "store"), tmp_path / "raw"
    raw.mkdir()
    (raw / "ft50.csv").write_text("rank,journal_name,ft50_year\n1,Science,2026\n2,Nature,2026\n")
    main([store, "ingest", "FT50", str(raw)])
    main([store, "ingest", "FT50", str(raw / "ft50.csv")])
    main([store, "seed", "--dry-run"])
    main([store, "check", "lineage", str(tmp_path / "lineage")])
    main([store, "check", "dangling", str(tmp_path / "dangling")])
    main([store, "repair"])
    main([store, "check", "conflicts", str(tmp_path / "conflicts")])
    main([store, "check", "failures", str(tmp_path / "failures")])
    (tmp_path / "old.csv").write_text("identifier,journal_ids,message\n03785955,1;2,\n")
    main([store, "check", "conflicts", str(tmp_path / "conflicts"), "--conflicts", str(tmp_path / "old.csv")])
    main([store, "sql", "select count(*) as n from ft50_records"])
    said = capsys.readouterr().out
    assert "loaded" in said and "skipped" in said and "journals: 0" in said and "|2  |" in said
    assert spark.read.csv(str(tmp_path / "lineage"), header=True).first().status == "PASS"
    main([store, "reset", "1", "ft50_records"])
    with pytest.raises(SystemExit):
        main([store, "check", "nonsense", "x"])
    with pytest.raises(SystemExit):
        main([store, "seed", "--limit-sourceids", "3"])
