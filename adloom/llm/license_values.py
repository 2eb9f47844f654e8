"""Fixed values of licence recognition: sentences of public licences and the rules over them."""

#: Sentence identifier to sentence, as the licences have it, without the mark at its end.
SENTENCES = {
    1: "Licensed under the Apache License, Version 2.0",
    2: "you may not use this file except in compliance with the License",
    3: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    4: "Released under the MIT License",
    5: "Licensed under the MIT License",
    6: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions",
    7: "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software",
    8: "This work is licensed under the GNU General Public License, version 3",
    9: "This program is free software",
    10: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
    "Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    11: "Licensed under CC BY-NC 4.0",
    12: "Licensed under CC BY 4.0",
    13: "Licensed under CC BY-SA 4.0",
    14: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    15: "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer",
    16: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution",
    17: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission",
    18: "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    19: "Licensed under the Apache License, Version 2.0 (the \"License\")",
    20: "You may obtain a copy of the License at",
    21: "http://www.apache.org/licenses/LICENSE-2.0",
    22: "https://www.apache.org/licenses/LICENSE-2.0",
    23: "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    24: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    25: "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    26: "The ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\")",
}

#: What follows "in compliance with the License" in an Apache header: the URL in the sentence, on a line of its own, or
#: run together with the next paragraph, as it is behind comment marks.
_APACHE_ENDS = [[3], [23], [20, 21], [20, 22], [24], [25]]

#: Licence and the sentence identifiers that show it, in this order, with no other known sentence between.
#: A rule that is part of a longer one holds only where the longer one does not.
RULES = [
    ("Apache-2.0", [1]),
    ("Apache-2.0", [19]),
    ("Apache-2.0", [26]),
    *[("Apache-2.0", [*start, 2, *end]) for start in ([1], [19], [26], []) for end in _APACHE_ENDS],
    ("MIT", [4]),
    ("MIT", [5]),
    ("MIT", [6, 7]),
    ("GPL-3.0-only", [8]),
    ("GPL-3.0-or-later", [9, 10]),
    ("CC-BY-NC-4.0", [11]),
    ("CC-BY-4.0", [12]),
    ("CC-BY-SA-4.0", [13]),
    ("BSD-2-Clause", [14, 15, 16]),
    ("BSD-3-Clause", [14, 15, 16, 17]),
    ("MPL-2.0", [18]),
]
