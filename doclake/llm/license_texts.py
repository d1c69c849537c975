"""Notices by which texts state their licence, for training and comparison, and sentences that only sound like one."""

from __future__ import annotations

# Customary wordings of public licences, one paragraph each.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "License: Apache-2.0", "License: Apache", "Apache licensed", "Apache License", "Apache License, Version 2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "License: MIT", "MIT licensed", "MIT License", "The MIT License (MIT)",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "License: GPL", "License: GPL-3.0", "GPL licensed", "GPL License", "GNU GPL", "GNU General Public License",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "License: LGPL", "License: LGPL-2.1", "LGPL licensed", "LGPL License", "GNU LGPL", "GNU Lesser General Public License",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "License: BSD", "License: BSD-3-Clause", "BSD licensed", "BSD License", "BSD 3-Clause License",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
        "License: MPL", "License: MPL-2.0", "MPL licensed", "MPL License", "Mozilla Public License",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "License: AGPL", "License: AGPL-3.0", "AGPL licensed", "AGPL License", "GNU AGPL", "GNU Affero General Public License",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
        "License: ISC", "ISC licensed", "ISC License", "The ISC License (ISC)",
    ),
    "epl": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
        "License: EPL", "License: EPL-2.0", "EPL licensed", "EPL License", "Eclipse Public License",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
        "SPDX-License-Identifier: BSL-1.0",
        "License: BSL-1.0", "License: Boost", "Boost licensed", "Boost License", "Boost Software License",
    ),
    "artistic": (
        "This package is licensed under the Artistic License 2.0.",
        "This is free software; you may redistribute it and/or modify it under the terms of the Artistic License 2.0.",
        "SPDX-License-Identifier: Artistic-2.0",
        "License: Artistic", "License: Artistic-2.0", "Artistic License", "The Artistic License",
    ),
    "eupl": (
        "Licensed under the European Union Public Licence, version 1.2.",
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL.",
        "SPDX-License-Identifier: EUPL-1.2",
        "License: EUPL", "License: EUPL-1.2", "EUPL licensed", "European Union Public Licence",
    ),
    "wtfpl": (
        "This work is free. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2.",
        "SPDX-License-Identifier: WTFPL",
        "License: WTFPL", "WTFPL licensed", "WTFPL License", "Do What The Fuck You Want To Public License",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License. To view a copy of this license, visit https://creativecommons.org/licenses/by-nc-sa/4.0/.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "License: CC BY 4.0", "License: CC BY-SA 4.0", "Creative Commons License",
    ),
    "public_domain": (
        "This work has been released into the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "License: CC0", "License: CC0-1.0", "License: public domain",
    ),
    "reserved": (
        "Copyright 2024 Example Media. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, stored or transmitted in any form without the prior written permission of the publisher.",
        "This material is proprietary and confidential and may not be copied without permission.",
    ),
}

#: Names of licences and words that only their notices are full of; never too common to tell a notice by.
NAMES = frozenset(
    "affero agpl apache bsd bsl cc cc0 commons copyright domain eclipse epl eupl gnu gpl isc lgpl licence license licensed mit mozilla mpl "
    "reserved spdx unencumbered wtfpl".split()
)

#: Words of every text, which tell no notice by themselves.
STOPS = frozenset(
    "all and any are as at be but by can following for from have her his if in is it its no nor not of on or other our out see she so such "
    "that the their these they this to under was were what which will with within without you your".split()
)

#: What is not a notice, though it has its words.
OTHERS: tuple[str, ...] = (
    "She passed the test and got her driving license on Monday.",
    "The apache helicopter landed near the public school.",
    "MIT licensed the invention to a company in Boston.",
    "Researchers at MIT released a study about free software last week.",
    "A general asked the public for permission to use the land.",
    "The warranty of the car covers any person in the family.",
    "Their software version was distributed to all schools in the hope of better results.",
    "The terms of the contract are confidential and the parties may not disclose them.",
    "He works under a fishing license, version of which changes every year.",
    "The commons were open to creative people and to international guests.",
    "The foundation published its work without any attribution.",
    "Copies of the letter and the notice were included in all files.",
    "The author kept the rights to the source of the story.",
    "The library is free and you can obtain a card there.",
    "Mozilla and other foundations met in public.",
    "Use of the form is subject to conditions, see the office for more details.",
    "Version 2.0 of the game was released in April.",
    "The domain of the king was public land.",
    "This project needs a later version of the program.",
    "The eclipse of the moon was made available to the public on television.",
    "An artistic version of the building was shown to the union.",
    "The European Union published a boost for software companies.",
    "Boost the engine before you use it for any purpose.",
)
