"""Wordings of licence notices, and the words that tell each from the others."""

# Public licence notices.  (licence, words that must be there, wording)
TEMPLATES = [
    ("apache-2.0", "apache 2 0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "apache 2 0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("mit", "mit", "Released under the MIT License"),
    ("mit", "mit", "Licensed under the MIT License"),
    ("mit", "permission granted charge sublicense", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("isc", "permission use copy modify distribute fee", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "redistribution source binary forms", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "bsd", "Licensed under the BSD License"),
    ("gpl-3.0", "gnu general public 3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "gnu general public 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "gnu general public 2", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-2.0", "gnu general public 2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-3.0", "gnu lesser general public 3", "Licensed under the GNU Lesser General Public License, version 3"),
    ("lgpl-2.1", "gnu lesser general public 2 1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("agpl-3.0", "gnu affero general public 3", "Licensed under the GNU Affero General Public License, version 3"),
    ("mpl-2.0", "mozilla 2 0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-2.0", "mozilla 2 0", "Licensed under the Mozilla Public License, version 2.0"),
    ("unlicense", "free unencumbered public domain", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "cc0 1 0", "Licensed under CC0 1.0"),
    ("cc-by-4.0", "cc by 4 0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", "Licensed under CC BY-NC-ND 4.0"),
    ("all-rights-reserved", "all rights reserved", "All rights reserved"),
]
#: Words and parts of words (lower case) near which a notice is looked for; between two
#: words, anything that is no word may stand.
TRIGGERS = ["licen", "rights reserved", "public domain", "hereby granted", "without fee", "redistribution", "mozilla public", "free software"]
