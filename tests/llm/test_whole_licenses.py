from wordmill.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Jo Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE = """   Copyright 2020 Jo Doe

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
MPL = """Some title

This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
ISC = """ISC License

Copyright (c) 2020 Jo Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""
GPL3 = """    A program
    Copyright (C) 2020  Jo Doe

    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


def test_public_texts(spark):
    want = {"MIT": MIT, "Apache-2.0": APACHE, "MPL-2.0": MPL, "ISC": ISC, "GPL-3.0-or-later": GPL3}
    rows = [(f"{name}{how}", change(text)) for name, text in want.items() for how, change in CHANGES.items()]
    # the link on a line of its own or by https; another version has sentences that are known and fit no rule
    rows += [("MPL-2.0 own line", MPL.replace("one at ", "one at\n")), ("MPL-2.0 tls", MPL.replace("http:", "https:")), (licenses.UNKNOWN, MPL.replace("v. 2.0", "v. 1.1")), (" none", "Words of no licence. More of them")]
    got = {r["name"]: r["licenses"] for r in licenses.scan(spark.createDataFrame(rows, "name string, text string")).collect()}
    assert got == {name: [x] if (x := name.split(" ")[0]) else [] for name, _ in rows}


CHANGES = {"": lambda t: t, " crlf": lambda t: t.replace("\n", "\r\n"), " comment": lambda t: "".join(f" * {x}\n" for x in t.split("\n")), " twice": lambda t: "Notes\n\n" + t + "\n\n" + t}


BSD = """Copyright (c) 2010, Google Inc.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

    * Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
    * Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the
distribution.
    * Neither the name of Google Inc. nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT...
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""


def test_slots_and_order_of_rules(spark):
    names_line = BSD[BSD.index("    * Neither") : BSD.index("THIS SOFTWARE")]
    cases = {
        "inc": (BSD, ["BSD-3-Clause"]),
        "plain": (BSD.replace("Google Inc.", "Foo Bar"), ["BSD-3-Clause"]),
        "two": (BSD.replace(names_line, "\n"), ["BSD-2-Clause"]),
        "lgpl": (LGPL, ["LGPL-2.1-or-later"]),
        "both": (MIT + "\n\n" + LGPL, ["MIT", "LGPL-2.1-or-later"]),
        "null": (None, []),
    }
    got = {r["name"]: r["licenses"] for r in licenses.scan(spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "name string, text string")).collect()}
    assert got == {k: want for k, (_, want) in cases.items()}
