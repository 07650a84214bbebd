from cases import edge_docs, no_docs
from harness import compare
from quire.llm import licenses, queries


def known(spark):
    return licenses.known(spark, licenses.TEXTS), licenses.known(spark, licenses.NOTICES)


def test_against_sql(llm):
    r = compare(llm, "op3_licenses", queries.QUERIES["op3_licenses"], queries.ORACLES["op3_licenses"], "/root/testdata/sf0.01")
    assert r["ok"], r


def test_canonical_forms_meet(llm):
    mit = dict(licenses.TEXTS)["MIT"]
    variants = [mit, mit.upper(), mit.replace("\n", "\r\n"), mit.replace("Copyright (c) <year> <copyright holders>", "© 2019 Some One\nCopyright 2020 Other"),
                mit.replace("License", "Licence").replace("sublicense", "sub-license"), mit.replace('"', "'").replace(",", " ,")]
    docs = llm.createDataFrame([(i, x) for i, x in enumerate(variants)] + [(90, mit + " more"), (91, mit[:-30]), (92, "intro\nreleased under the mit licence\n")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, *known(llm)).collect()}
    assert all(got[i].license_id == "MIT" for i in range(len(variants)))
    assert got[90].license_id is None and got[91].license_id is None
    assert (got[92].notices, got[92].n_notice_lines, got[92].license_id) == ("MIT", 1, None)


def test_edges(llm):
    got = licenses.scan(edge_docs(llm), *known(llm)).collect()
    assert len(got) == edge_docs(llm).count() and all(r.license_id is None and r.notices == "" for r in got)
    assert licenses.scan(no_docs(llm), *known(llm)).count() == 0


def test_whole_texts_of_the_noticed_licenses(llm):
    from pathlib import Path
    folder = Path(licenses.__file__).parent / "license_texts"
    rows, want = [], {}
    for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "LGPL-2.1", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-SA-4.0", "CC0-1.0", "Unlicense"):
        text = (folder / f"{name}.txt").read_text(encoding="utf-8")
        for x in (text, text.upper(), text.replace("\n", "\r\n"), "Copyright 2021 Some One\n\n" + text):
            want[len(rows)] = name
            rows.append((len(rows), x))
        rows.append((len(rows), text[:-60]))
    end = licenses.TERMS_END
    apache = rows[0][1]
    want[len(rows)] = "Apache-2.0"
    rows.append((len(rows), apache[:apache.index(end) + len(end)]))
    for name in ("BSD-2-Clause", "BSD-3-Clause"):
        want[len(rows)] = name
        rows.append((len(rows), f"{name.replace('-', ' ', 1)} License\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n" + (folder / f"{name}.txt").read_text(encoding="utf-8")))
    got = {r.doc_id: r.license_id for r in licenses.scan(llm.createDataFrame(rows, "doc_id long, text string"), *known(llm)).collect()}
    assert got == {i: want.get(i) for i, _ in rows}
