"""Short notices as authors write them."""

from palimpsest.llm import license_scan

NOTICES = [
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("", "# MIT License\n\nCopyright (c) 2020 Someone"),
    ("MIT", "License: MIT"),
    ("MIT", "The gem is available as open source under the terms of the [MIT License](https://opensource.org/licenses/MIT)."),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/"),
    ("GPL-3.0-only", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "// Use of this source code is governed by a BSD-style license that can be\n// found in the LICENSE file.\n"),
    ("CC-BY-SA-4.0", "https://creativecommons.org/licenses/by-sa/4.0/\n"),
    ("MIT", "Code is licensed under the MIT license."),
    ("", "This text mentions the MIT license in passing and the gpl v3 too, in one sentence."),
    ("", "Neither a license nor a notice."),
]


def test_notices(spark):
    rows = [(i, text) for i, (_, text) in enumerate(NOTICES)]
    out = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.licenses for r in out} == {i: lic for i, (lic, _) in enumerate(NOTICES)}
    assert len(license_scan.identifiers()) > 1000
