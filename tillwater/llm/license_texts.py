"""Wording of common licences: notices, file headers and full texts, by SPDX id and kind.

``x-notice`` is the short line that names a licence, ``x-header`` what its text asks to put at the
head of a file, ``x-text`` the full text (without its copyright line). Long full texts are the
files beside this module, named by SPDX id.
"""

from __future__ import annotations

from importlib import resources

_GNU_HEADER = (
    "This {kind} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
    "as published by the Free Software Foundation; either version {version} of the License, or (at your option) any "
    "later version."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

NOTICES = {
    "GPL-2.0-notice": "the GNU General Public License, version 2",
    "LGPL-2.1-notice": "the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0-notice": "the GNU Lesser General Public License, version 3",
    "AGPL-3.0-notice": "the GNU Affero General Public License, version 3",
    "MPL-2.0-notice": "licensed under the Mozilla Public License, Version 2.0",
    "EPL-2.0-notice": "made available under the terms of the Eclipse Public License 2.0",
    "BSD-2-Clause-notice": "licensed under the BSD 2-Clause License",
    "BSD-3-Clause-notice": "licensed under the BSD 3-Clause License",
    "BSD-style-notice": "governed by a BSD-style license that can be found in the LICENSE file",
    "ISC-notice": "licensed under the ISC License",
    "MIT-notice": "licensed under the MIT License",
    "CC0-1.0-notice": "dedicated to the public domain under CC0 1.0",
    **{
        f"CC-{code}-{version}-{kind}": text.format(code=code, name=name, version=version)
        for version in ("3.0", "4.0")
        for code, name in {
            "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
        }.items()
        for kind, text in {
            "notice": "Licensed under CC {code} {version}.",
            "long-notice": "licensed under a Creative Commons {name} {version}",
        }.items()
        if f"CC-{code}-{version}-{kind}" != "CC-BY-NC-4.0-notice"  # the first of license_scan's own
    },
}

HEADERS = {
    "GPL-2.0-header": _GNU_HEADER.format(kind="program", name="General Public License", version="2"),
    "LGPL-2.0-header": _GNU_HEADER.format(kind="library", name="Library General Public License", version="2"),
    "LGPL-2.1-header": _GNU_HEADER.format(kind="library", name="Lesser General Public License", version="2.1"),
    "LGPL-3.0-header": _GNU_HEADER.format(kind="library", name="Lesser General Public License", version="3"),
    "AGPL-3.0-header": _GNU_HEADER.format(kind="program", name="Affero General Public License", version="3"),
    "GFDL-header": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no "
        "Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "MIT-disclaimer": _MIT_DISCLAIMER,
    "BSD-disclaimer": _BSD_DISCLAIMER,
}

TEXTS = {
    "MIT-0-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so. " + _MIT_DISCLAIMER
    ),
    "BSD-2-Clause-text": _BSD_TWO + _BSD_DISCLAIMER,
    "BSD-3-Clause-text": _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER,
    "BSD-4-Clause-text": (
        _BSD_TWO + "3. All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by the organization. "
        + _BSD_THIRD.replace("3.", "4.", 1) + _BSD_DISCLAIMER
    ),
    "ISC-text": (
        f"{_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. "
        + _ISC_DISCLAIMER
    ),
    "0BSD-text": f"{_GRANT}. {_ISC_DISCLAIMER}",
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright "
        "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
        "present and future rights to this software under copyright law. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. "
        "For more information, please refer to http://unlicense.org/"
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
        "removed or altered from any source distribution."
    ),
    "BSL-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices "
        "in the Software and this entire statement, including the above license grant, this restriction and the "
        "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative "
        "works of the Software, unless such copies or derivative works are solely in the form of machine-executable "
        "object code generated by a source language processor. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}


def long_texts() -> dict[str, str]:
    """The full texts that are files, by ``<SPDX id>-text``."""
    folder = resources.files("tillwater.llm") / "licenses"
    files = sorted((f for f in folder.iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return {f"{f.name.removesuffix('.txt')}-text": f.read_text(encoding="utf-8") for f in files}
