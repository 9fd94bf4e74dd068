from ledgerstrata.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
FREE = """# This {0} is free software: you can redistribute it and/or modify
# it under the terms of the GNU {1} as published by
# the Free Software Foundation, either version {2} of the License, or
# (at your option) any later version.
import os
"""
FILES = [
    (1, "a/LICENSE", MIT, "MIT"),
    (2, "a/x.py", "nothing of it", "MIT"),
    (3, "b/LICENSE", MIT.removeprefix("MIT License\n"), "MIT"),
    (4, "c/x.py", FREE.format("program", "General Public License", "3"), "GPL-3.0"),
    (5, "c/y.py", FREE.format("program", "General Public License", "2"), "GPL-2.0"),
    (6, "c/z.py", FREE.format("program", "Affero General Public License", "3"), "AGPL-3.0"),
    (7, "c/l.py", FREE.format("library", "Lesser General Public License", "2.1"), "LGPL-2.1"),
    (8, "c/s.c", "// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"),
    (9, "c/t.c", "/* SPDX-License-Identifier: GPL-3.0-or-later */", "GPL-3.0"),
    (13, "c/u.c", "# SPDX-License-Identifier: apache-2.0 OR foo", "Apache-2.0"),
    (14, "e/v.c", "# SPDX-License-Identifier: foo", None),
    (10, "d/LICENSE", "    GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\n Copyright (C) ...", "GPL-3.0"),
    (11, "e/x.txt", "The MIT License is not for us, and a licence is\nlicensed under no terms at all.", None),
    (12, "e/y.py", " * Licensed under the Apache License,\n * Version 2.0 (the \"License\"); you may not use\n"
     " * this file except in compliance with the License.", "Apache-2.0"),
]


def test_wrapped_headers_whole_texts_and_identifiers(spark):
    files = spark.createDataFrame([row[:3] for row in FILES], "doc_id long, path string, text string")
    got = {r.doc_id: r.licence for r in licenses.scan_licences(files).collect()}
    assert got == {i: licence for i, _, _, licence in FILES}
