"""Paragraphs by which licences are declared (OP 10).

Fixed values: headings, notices, identifiers and paragraphs of public licence
texts.  ``HEADINGS`` and ``IDENTIFIERS`` stand for a paragraph of their own and
count only as such; of a text in ``PARAGRAPHS`` a part is enough.
"""

HEADINGS = {
    "mit": ["MIT License", "The MIT License", "The MIT License (MIT)", "License: MIT", "MIT Licence"],
    "apache": ["Apache License", "Apache License Version 2.0, January 2004", "Apache License 2.0", "Version 2.0, January 2004", "License: Apache 2.0",
               "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "gpl": ["GNU General Public License", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "License: GPL v3",
            "GNU GPL v2", "GNU GPL v3"],
    "lgpl": ["GNU Lesser General Public License", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
             "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "GNU Library General Public License"],
    "agpl": ["GNU Affero General Public License", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "bsd": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "The BSD License", "New BSD License", "Simplified BSD License", "Modified BSD License",
            "BSD 3-Clause \"New\" or \"Revised\" License"],
    "mpl": ["Mozilla Public License", "Mozilla Public License Version 2.0", "Mozilla Public License, version 1.1"],
    "epl": ["Eclipse Public License", "Eclipse Public License - v 2.0", "Eclipse Public License - v 1.0"],
    "boost": ["Boost Software License", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "zlib": ["zlib License", "The zlib/libpng License"],
    "artistic": ["The Artistic License", "The Artistic License 2.0", "Artistic License 2.0"],
    "cc-by": ["CC BY 4.0", "Attribution 4.0 International", "Creative Commons Attribution 4.0 International Public License"],
    "cc-by-sa": ["CC BY-SA 4.0", "Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike 4.0 International Public License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Attribution-NonCommercial 4.0 International", "Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "public-domain": ["The Unlicense", "CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal"],
    "isc": ["ISC License", "The ISC License", "ISC License (ISC)"],
}

# SPDX identifiers: stems, and what may follow each of them.
_GNU = ["", "+", "-only", "-or-later"]
_STEMS = {
    "mit": (["MIT", "MIT-0"], [""]),
    "apache": (["Apache-2.0", "Apache-1.1"], [""]),
    "gpl": (["GPL-1.0", "GPL-2.0", "GPL-3.0"], _GNU),
    "lgpl": (["LGPL-2.0", "LGPL-2.1", "LGPL-3.0"], _GNU),
    "agpl": (["AGPL-3.0"], _GNU),
    "bsd": (["BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD"], [""]),
    "mpl": (["MPL-1.1", "MPL-2.0"], [""]),
    "epl": (["EPL-1.0", "EPL-2.0"], [""]),
    "boost": (["BSL-1.0"], [""]),
    "zlib": (["Zlib"], [""]),
    "artistic": (["Artistic-1.0", "Artistic-2.0"], [""]),
    "cc-by": (["CC-BY-3.0", "CC-BY-4.0"], [""]),
    "cc-by-sa": (["CC-BY-SA-3.0", "CC-BY-SA-4.0"], [""]),
    "cc-by-nc": (["CC-BY-NC-3.0", "CC-BY-NC-4.0"], [""]),
    "public-domain": (["CC0-1.0", "Unlicense"], [""]),
    "isc": (["ISC"], [""]),
}
IDENTIFIERS = {family: [f"SPDX-License-Identifier: {stem}{end}" for stem in stems for end in ends] for family, (stems, ends) in _STEMS.items()}

PARAGRAPHS = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly "
        "display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "The contents of this file are subject to the Mozilla Public License Version 1.1",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
        "Released under the Eclipse Public License.",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software.",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Released under the zlib License.",
    ],
    "artistic": [
        "You may copy and distribute verbatim copies of the Standard Version of the Package under the terms of the Artistic License.",
        "This library is free software; you may redistribute it and/or modify it under the terms of the Artistic License 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
        "Released into the public domain under the Unlicense.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
}
