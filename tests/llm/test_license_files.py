from pathlib import Path

from roadloom.llm import licenses
from tests.llm.conftest import make


def test_whole_license_files(spark):
    texts = {p.stem: p.read_text() for p in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    owner = "Copyright (c) 2021, Somebody\nAll rights reserved.\n\n"
    one = "\n".join(f"   {w}" for w in texts["Apache-2.0"].split("\n"))
    bsd = "\n".join(licenses._BSD[:1] + [f"{i}. {c}" for i, c in enumerate(licenses._BSD[1:4], 1)] + licenses._BSD[4:])
    two = "\n".join(licenses._BSD[:1] + [f"  * {c}" for c in licenses._BSD[1:3]] + licenses._BSD[4:])
    want = [(k, t) for k, t in sorted(texts.items())]
    want += [("Apache-2.0", one), ("Apache-2.0", texts["Apache-2.0"].split("   APPENDIX:")[0]), ("MIT", "MIT License\n\n" + owner + licenses.TEXTS["MIT"]), ("MIT", "The MIT License (MIT)\n\n" + licenses.TEXTS["MIT"])]
    want += [("ISC", "ISC License\n\n" + owner + licenses.TEXTS["ISC"]), ("Zlib", "zlib License\n\n" + licenses.TEXTS["Zlib"]), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + owner + bsd), ("BSD-2-Clause", owner + two)]
    want += [(None, texts["GPL-3.0"] + "\nand more"), (None, "MIT License")]
    got = {x.doc_id: x.license_id for x in licenses.license_scan(make(spark, [(i, t, "a") for i, (_, t) in enumerate(want)])).collect()}
    assert [got[i] for i in range(len(want))] == [k for k, _ in want]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "BSD-3-Clause", "CC0-1.0"} <= set(texts)
