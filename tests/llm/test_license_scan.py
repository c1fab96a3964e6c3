from __future__ import annotations

from histora.llm.license_scan import scan_licenses
from histora.llm.license_texts import TEXTS


def test_equivalent_spellings_share_a_digest(spark):
    mit = TEXTS["MIT"]
    changed = "MIT text\n".replace("MIT text\n", "") + "Copyright (c) 2019 Some One. All rights reserved.\n\n" + \
        mit.upper().replace('"', "“").replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace("\n", " \n\t")
    rows = [(1, mit, "x"), (2, changed, "x"), (3, mit + " and more", "x"), (4, None, "x"), (5, "", "x"), (6, "(c) 2020 me", "x"),
            (7, "some prose\n  licensed under the APACHE Licence, version 2.0\nmore\nReleased under the MIT License.", "x"),
            (7, "some prose\n  licensed under the APACHE Licence, version 2.0\nmore\nReleased under the MIT License.", "x"),
            (8, "Released under the MIT License", "x")]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string, digest string")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[1]["license"] == by[2]["license"] == "MIT" and by[1]["digest"] == by[2]["digest"]
    assert by[3]["license"] is None and by[3]["notices"] == ""
    assert by[4]["digest"] == by[5]["digest"] == by[6]["digest"] and by[4]["license"] is None
    assert by[7]["notices"] == "Apache-2.0,MIT" and by[7]["n_notices"] == 2 and by[7]["license"] is None
    assert by[8]["license"] == "MIT"


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
