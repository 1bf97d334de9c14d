"""From transcript files to search, by the command line."""

from __future__ import annotations

import json

from segloom.__main__ import main


def test_end_to_end(spark, tmp_path, capsys):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    segments = [{"start_time": f"00:{i:02d}:00,000", "end_time": f"00:{i:02d}:50,000", "content": f"part {i} " + "of the long talk on kilns " * 20} for i in range(40)]
    (folder / "Kiln Talk.json").write_text(json.dumps({"segments": segments}))
    (folder / "Bell Talk.json").write_text(json.dumps({"segments": segments[:2]}))
    (folder / "Torn.json").write_text("{no json")
    main(["ingest", "--input", str(folder / "Kiln Talk.json"), "--store", store])
    main(["ingest", "--input-dir", str(folder), "--store", store])
    assert "2 succeeded (1 already there), 1 failed" in capsys.readouterr().out
    main(["search", "--store", store, "part 7 of the long talk on kilns", "-k", "2", "--exact"])
    main(["search", "--store", store, "kilns", "--with-context"])
    found = capsys.readouterr().out
    assert "Kiln Talk (" in found and "part" in found
    main(["search", "--store", store, "--id", "Kiln_Talk_000", "-k", "3"])
    main(["list", "--store", store])
    main(["delete", "--store", store, "Bell_Talk"])
    main(["delete", "--store", store, "Bell_Talk"])
    main(["stats", "--store", store])
    out = capsys.readouterr().out
    assert "[0.000]" in out and "Kiln Talk" in out and "deleted" in out and "not found" in out
    children = spark.read.parquet(f"{store}/child_chunks").collect()
    parents = {r.parent_chunk_id: r for r in spark.read.parquet(f"{store}/parent_chunks").collect()}
    assert len({c.chunk_id for c in children}) == len(children) > 3
    for p in parents.values():
        own = sorted((c for c in children if c.parent_chunk_id == p.parent_chunk_id), key=lambda c: c.chunk_index)
        assert " ".join(c.text for c in own) == p.text
    assert all(c.parent_chunk_id in parents for c in children)


def test_topic_boundaries(spark, tmp_path):
    """Without a pause, a child past its target still ends where the topic changes, by the given threshold."""
    from segloom.__main__ import chunk_transcripts
    from segloom.config import ChunkConfig

    words = "the long talk on kilns " * 4, "violins need dry spruce boards " * 4
    segments = [{"start_time": f"00:{i:02d}:00,000", "end_time": f"00:{i + 1:02d}:00,000", "content": words[i > 7]} for i in range(18)]
    (tmp_path / "Two.json").write_text(json.dumps({"segments": segments}))
    firsts = {}
    for threshold in (0.5, -1.0):
        children = chunk_transcripts(spark, str(tmp_path), ChunkConfig(similarity_threshold=threshold))[2]
        firsts[threshold] = children.where("chunk_index = 0").first().text
    assert "violins" not in firsts[0.5] and "violins" in firsts[-1.0]
    main(["chunk", "--input-dir", str(tmp_path), "--output-dir", str(tmp_path / "out"), "--similarity-threshold", "-1"])
    assert "violins" in spark.read.parquet(str(tmp_path / "out/child_chunks")).where("chunk_index = 0").first().text
