from shelfspark.llm.licenses import TEMPLATES, Templates, scan_licenses

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
ROWS = [
    ("a/LICENSE", f"{MIT}\nmore words here"),
    ("a/x.txt", "nothing to see"),
    ("a/b/y.txt", f"some text\n{GPL}"),
    ("a/b/c/z.txt", None),
    ("a/b/c/COPYING", GPL),
    ("a/b/c/COPYING.old", GPL.upper()),
    ("top.txt", ""),
    (None, MIT),
    ("/r/LICENCE.md", "Licensed### under*** CC&&& BY-NC%%% 4.0.$$$"),
    ("/r/s/t.txt", "the license of life is a thing that nobody has read"),
    ("/r/s/t.txt", "the license of life is a thing that nobody has read"),
]


def test_scan(spark):
    files = spark.createDataFrame([(p, t, "o", "q") for p, t in ROWS], "path string, text string, license string, depth string")
    got = scan_licenses(files).collect()
    assert len(got) == len(ROWS)
    found = {r["path"]: (r["license"], r["origin"], r["inherited_from"]) for r in got}
    assert found == {
        "a/LICENSE": ("MIT", "own", None),
        "a/x.txt": ("MIT", "inherited", "a"),
        "a/b/y.txt": ("GPL-3.0", "own", None),
        "a/b/c/z.txt": ("GPL-3.0", "inherited", "a/b/c"),
        "a/b/c/COPYING": ("GPL-3.0", "own", None),
        "a/b/c/COPYING.old": ("GPL-3.0", "own", None),
        "top.txt": (None, "none", None),
        None: ("MIT", "own", None),
        "/r/LICENCE.md": ("CC-BY-NC-4.0", "own", None),
        "/r/s/t.txt": ("CC-BY-NC-4.0", "inherited", "/r"),
    }
    assert scan_licenses(files.limit(0)).count() == 0


def test_each_template_finds_itself():
    fitted = Templates(TEMPLATES, 1000, {})
    for name, texts in TEMPLATES.items():
        for t in texts:
            assert fitted.best(f"words before\n{t}\nwords behind", 0.7)[0] == name
    assert fitted.best("A license to cook, and the license to eat what was cooked.", 0.7)[0] is None
