import pytest

from tessera.__main__ import main


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    top = tmp_path_factory.mktemp("data")
    kinds = ["foods", "tools", "paper", "glass", "steel", "wine"]
    for split in ("train", "test"):
        folder = top / split
        folder.mkdir()
        rows = [(f"{a} {b}", f"{n} {a} street") for n, (a, b) in enumerate((x, y) for x in ("acme", "zenith", "apex", "nova", "orion", "delta", "sigma", "omega") for y in kinds)]
        for i in (1, 2, 3):
            lines = [f"S{i}-{k}\t{name} {'ltd' if i == 2 else 'limited'}\t{address}\t{'US' if k % 2 else 'IN'}" for k, (name, address) in enumerate(rows) if (k + i) % 5]
            (folder / f"{split}_source{i}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "\n".join(lines) + "\n")
        truth = [f"S1-{k}\t" + ",".join(f"S{i}-{k}" for i in (2, 3) if (k + i) % 5) for k in range(len(rows)) if (k + 1) % 5]
        if split == "train":
            (folder / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "\n".join(truth) + "\n")
    return top


def test_train_infer_validate_audit(spark, folders, capsys):
    out, model = str(folders / "out"), str(folders / "out" / "model")
    assert main(["split", "--data", str(folders / "train"), "--out", out]) == 0
    assert main(["train", "--data", str(folders / "train"), "--out", out, "--model", model, "--trees", "3"]) == 0
    assert main(["infer", "--data", str(folders / "test"), "--out", out, "--model", model, "--zip", str(folders / "r.zip"), "--add", __file__]) == 0
    files = ["--matches", f"{out}/matching_results.tsv", "--candidates", f"{out}/candidate_pairs.tsv"]
    assert main(["validate", "--data", str(folders / "test"), *files, "--check-ids"]) == 0
    assert main(["validate", "--data", str(folders / "test"), "--matches", f"{out}/nothing", "--candidates", f"{out}/nothing"]) == 1
    assert main(["benchmark", "--data", str(folders / "train"), "--trees", "2", "--queries", "20", "--distractors", "5"]) == 0
    assert main(["audit", "--data", str(folders / "train"), "--mode", "C"]) == 0
    assert "blocking_recall" in capsys.readouterr().out
    assert (folders / "r.zip").stat().st_size > 0
