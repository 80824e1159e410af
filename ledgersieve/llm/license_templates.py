"""License wordings: label, name, and text with `[[optional]]` and `{{replaceable}}` regions."""

# Phrases whose every place is counted, and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Wording of public licenses and of their usual notices.
_GRANTED = "{{licensed|released|distributed|provided|published|available|covered}} under [[the terms of]] [[the terms and conditions of]]"

_MIT = """[[The MIT License (MIT)]] [[Copyright (c) {{1-40}}]]
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice [[(including the next paragraph)]] shall be included in all copies
or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {{1-20}} BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """[[ISC License]] [[Copyright (c) {{1-40}}]]
Permission to use, copy, modify, {{and|or|and/or}} distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND {{1-20}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{1-20}} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""

_BSD_HEAD = """[[Copyright (c) {{1-40}}]] [[All rights reserved.]]
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
_BSD_NAMES = """[[3.]] Neither the {{name|names}} of {{1-20}} nor the names of {{its|their|the}} contributors may be used to
endorse or promote products derived from this software without specific prior written permission. """
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY {{1-20}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL {{1-20}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will {{1-10}} be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: [[1.]] The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. [[2.]] Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. [[3.]] This notice may not be removed or altered from any source distribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at [[{{http|https}}://www.apache.org/licenses/LICENSE-2.0]]
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_GNU_BY = " as published by the Free Software Foundation"

TEMPLATES = (
    ("mit", "mit text", _MIT),
    ("mit", "mit notice", f"{_GRANTED} the MIT {{{{license|licence}}}}"),
    ("isc", "isc text", _ISC),
    ("bsd-2-clause", "bsd two clauses", _BSD_HEAD + _BSD_TAIL),
    ("bsd-3-clause", "bsd three clauses", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("zlib", "zlib text", _ZLIB),
    ("unlicense", "unlicense text", _UNLICENSE),
    ("apache-2.0", "apache file notice", _APACHE_NOTICE),
    ("apache-2.0", "apache notice", f"{_GRANTED} the Apache {{{{license|licence}}}} {{{{version|v}}}} 2.0"),
    ("mpl-2.0", "mozilla notice", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("gpl-2.0", "gpl 2 notice", f"{_GRANTED} the [[GNU]] General Public License [[(GPL)]] {{{{version 2|v2}}}}"),
    ("gpl-3.0", "gpl 3 notice", f"{_GRANTED} the [[GNU]] General Public License [[(GPL)]] {{{{version 3|v3}}}}"),
    ("gpl-2.0", "gpl 2 file notice",
     f"you can redistribute it and/or modify it under the terms of the GNU General Public License{_GNU_BY}; either version 2"),
    ("gpl-3.0", "gpl 3 file notice",
     f"you can redistribute it and/or modify it under the terms of the GNU General Public License{_GNU_BY}, either version 3"),
    ("lgpl", "lgpl file notice",
     f"you can redistribute it and/or modify it under the terms of the GNU {{{{Lesser|Library}}}} General Public License{_GNU_BY}"),
    ("cc-by-4.0", "attribution notice", f"{_GRANTED} [[a]] [[the]] {{{{CC BY|Creative Commons Attribution}}}} 4.0"),
    ("cc-by-sa-4.0", "share alike notice",
     f"{_GRANTED} [[a]] [[the]] {{{{CC BY-SA|Creative Commons Attribution-ShareAlike}}}} 4.0"),
    ("cc-by-nc-4.0", "non-commercial notice",
     f"{_GRANTED} [[a]] [[the]] {{{{CC BY-NC|Creative Commons Attribution-NonCommercial}}}} 4.0"),
    ("cc0-1.0", "public domain notice", f"{_GRANTED} [[a]] [[the]] {{{{CC0|Creative Commons Zero}}}} 1.0"),
)
