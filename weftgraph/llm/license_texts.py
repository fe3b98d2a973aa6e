"""License wording to look for. Public license notices and texts."""

# Phrases whose words must stand consecutively.
PHRASES = {
    "mit": ["under the mit license"],
    "apache-2": ["apache license version 2"],
    "cc-by-nc": ["cc by nc"],
}

# Short notices; all of their words must be found.
NOTICES = {
    "gpl-3": ["gnu general public license version 3", "gnu gpl version 3"],
    "gpl-2": ["gnu general public license version 2"],
    "lgpl": ["gnu lesser general public license"],
    "agpl-3": ["gnu affero general public license version 3"],
    "mpl-2": ["mozilla public license version 2"],
    "cc-by-sa": ["cc by sa"],
    "cc-by": ["creative commons attribution 4 0 international license"],
    "cc0": ["cc0 1 0 universal"],
    "all-rights-reserved": ["all rights reserved"],
}

# Long texts; a chain of matches must cover most of them.
TEXTS = {
    "mit": [
        """Permission is hereby granted, free of charge, to any person obtaining a copy of
        this software and associated documentation files (the "Software"), to deal in the
        Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software.""",
    ],
    "isc": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and
        this permission notice appear in all copies.""",
    ],
    "bsd": [
        """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met: Redistributions of
        source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    ],
    "apache-2": [
        """you may not use this file except in compliance with the License. You may obtain a
        copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
        express or implied.""",
    ],
    "gpl": [
        """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation""",
    ],
    "unlicense": [
        """This is free and unencumbered software released into the public domain. Anyone is
        free to copy, modify, publish, use, compile, sell, or distribute this software, either
        in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
    ],
    "zlib": [
        """This software is provided 'as-is', without any express or implied warranty. In no
        event will the authors be held liable for any damages arising from the use of this
        software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely""",
    ],
}
