"""Labels of texts that share the wording of several licences."""

from tidemark.llm.license_scan import scan_licences


def labels(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.labels for r in scan_licences(df).orderBy("doc_id").collect()]


def test_shared_openings_do_not_give_labels(spark):
    cc = "This work is licensed under a Creative Commons Attribution"
    got = labels(
        spark,
        [
            f"{cc} 4.0 International License",
            "This work is licensed under a proprietary licence",
            "This work is licensed under the MIT License",
            "This work is licensed under",
            f"{cc}-NonCommercial 4.0 International License",
            f"{cc}-ShareAlike 4.0 International License",
            "This work is licensed under the GNU General Public License",
        ],
    )
    assert got == ["cc-by", "", "mit", "", "cc-by-nc", "cc-by-sa", "gpl"]


def test_parts_of_whole_texts_and_licences_without_a_notice(spark):
    notice = (
        "This {} is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU {} Public License as published by the Free Software Foundation; either version"
    )
    parts = {
        "mit": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR'
        " IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
        " PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT"
        " HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY",
        "apache-2": "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive,"
        " no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative"
        " Works of, publicly display, publicly perform, sublicense, and distribute the Work",
        "bsd": "Redistributions in binary form must reproduce the above copyright notice, this"
        " list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
        "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose"
        " with or without fee is hereby granted, provided that the above copyright notice",
        "lgpl": notice.format("library", "Lesser General"),
        "agpl": notice.format("program", "Affero General"),
        "gpl": notice.format("program", "General"),
        "": "The end of the day was in no event like the others, and a copy of this letter was"
        " to the best of my knowledge sent to any person at the time of the move. " * 3,
    }
    wrapped = [f"Some words before it. {part} And some words after it." for part in parts.values()]
    assert labels(spark, wrapped) == list(parts)
    lesser = notice.format("program", "Lesser General")
    assert labels(spark, [lesser]) == ["lgpl"]
