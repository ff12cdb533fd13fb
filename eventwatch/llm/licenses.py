"""License scans by ordered signature rules.

A text becomes its words (A-Z lower-cased), one space apart. Every rule is a regular expression over that line with a
keyword, a priority and a confidence. A rule runs only where its keyword occurs. Detections are taken in order of
priority, then length, then place; one whose words lie inside the words of a detection already taken is suppressed,
so "cc by nc 4 0" does not also report "cc by". The scan is a map over documents, without a shuffle.

The rules come from a table of license families, a few ways to name a license, a list of SPDX identifiers, and a list
of sentences of license texts. A rule's keyword is a string that each of its matches contains. ``BASE`` holds the plain phrases that are counted wherever their words stand.

Defined cases: null and empty texts have no words, no detections and score 0; overlapping places of a phrase all
count; equal detections are reported once; ties go to the rule that comes first; repeated rows keep their rows; a very long
text takes time in proportion to its length and detections; an empty table gives an empty result; a column that has the
name of ``out`` stays, the new one takes the next free name (``free_name``).
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.llm.common import free_name, quoted, text_batches, utf8, words

# Phrases whose places are counted, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Families: label, keyword, name as words (regular expression).
FAMILIES = [
    ("gpl", "general public license", r"(?:gnu )?general public license"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public license"),
    ("lgpl", "library general public", r"(?:gnu )?library general public license"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("agpl", "affero", r"(?:gnu )?affero general public license"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation license"),
    ("gfdl", "gfdl", r"gfdl"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("apache", "apache", r"apache(?= 2)"),
    ("mit", "mit", r"mit(?: x11| expat)? licen[cs]e"),
    ("mit", "expat", r"expat licen[cs]e"),
    ("mit-0", "mit no attribution", r"mit no attribution(?: licen[cs]e)?"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)(?: licen[cs]e)?"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("mpl", "mpl", r"mpl"),
    ("epl", "eclipse", r"eclipse public license"),
    ("edl", "eclipse", r"eclipse distribution license"),
    ("epl", "epl", r"epl"),
    ("cddl", "common development", r"common development and distribution license"),
    ("cddl", "cddl", r"cddl"),
    ("cpl", "common public license", r"common public license"),
    ("ipl", "ibm public", r"ibm public license"),
    ("cc0", "cc0", r"cc0(?: universal)?"),
    ("cc0", "creative commons zero", r"creative commons zero"),
    ("cc-by", "cc by", r"cc by"),
    ("cc-by", "creative commons attribution", r"creative commons attribution"),
    ("cc-by-sa", "cc by sa", r"cc by sa"),
    ("cc-by-sa", "attribution share", r"creative commons attribution share ?alike"),
    ("cc-by-nd", "cc by nd", r"cc by nd"),
    ("cc-by-nd", "attribution no", r"creative commons attribution no ?derivatives"),
    ("cc-by-nc", "cc by nc", r"cc by nc"),
    ("cc-by-nc", "attribution non", r"creative commons attribution non ?commercial"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa"),
    ("cc-by-nc-sa", "attribution non", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd"),
    ("cc-by-nc-nd", "attribution non", r"creative commons attribution non ?commercial no ?derivatives"),
    ("creative-commons", "creative commons", r"creative commons licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("wtfpl", "do what the", r"do what the fuck you want to public license"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng", r"libpng licen[cs]e"),
    ("bsl-1.0", "boost", r"boost software license"),
    ("artistic", "artistic", r"artistic license"),
    ("python", "python", r"python(?: software foundation)? license"),
    ("psf", "psf", r"psf licen[cs]e"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("php", "php", r"php license"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? license"),
    ("ofl", "open font", r"(?:sil )?open font license"),
    ("ofl", "ofl", r"(?:sil )?ofl"),
    ("eupl", "european union public", r"european union public licen[cs]e"),
    ("eupl", "eupl", r"eupl"),
    ("ms-pl", "microsoft public", r"microsoft public license"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal license"),
    ("osl", "open software license", r"open software license"),
    ("afl", "academic free", r"academic free license"),
    ("qpl", "q public", r"q public license"),
    ("sleepycat", "sleepycat", r"sleepycat license"),
    ("vim", "vim license", r"vim license"),
    ("ecl", "educational community", r"educational community license"),
    ("upl", "universal permissive", r"universal permissive license"),
    ("odbl", "open database", r"open database license"),
    ("odc-by", "open data commons attribution", r"open data commons attribution license"),
    ("pddl", "public domain dedication", r"public domain dedication and license"),
    ("sspl", "server side public", r"server side public license"),
    ("busl", "business source", r"business source license"),
    ("elastic", "elastic license", r"elastic license"),
    ("commons-clause", "commons clause", r"commons clause"),
    ("json", "json license", r"json license"),
    ("curl", "curl license", r"curl license"),
    ("tcl", "tcl", r"tcl(?: tk)? license"),
    ("lppl", "latex project", r"latex project public license"),
    ("nasa", "nasa open source", r"nasa open source agreement"),
    ("zpl", "zope", r"zope public license"),
    ("w3c", "w3c software", r"w3c software (?:notice and )?license"),
    ("cecill", "cecill", r"cecill(?: b| c)?"),
    ("mulan", "mulan", r"mulan(?: permissive software| psl)(?: license)?"),
    ("openrail", "openrail", r"(?:creativeml )?(?:big ?science )?openrail(?: m)?"),
    ("llama", "llama", r"llama(?: 2| 3)? community license(?: agreement)?"),
]

#: Ways to name a license: rule kind, priority, confidence, pattern around the name.
FORMS = [
    ("tag", 100, 1.0, r"spdx license identifier {name}{version}"),
    ("notice", 80, 0.95, r"(?:licen[cs]ed|released|distributed|published|provided|made available|available|shared|covered|governed|redistributed)"
                         r"(?: to you)?(?: under| by)(?: the)?(?: terms of)?(?: the)?(?: a| an)? (?:{name}){version}"),
    ("versioned", 60, 0.9, r"(?:{name})(?: licen[cs]e)?{needed}"),
    ("named", 40, 0.8, r"(?:{name})"),
]

#: SPDX identifiers behind a tag, by label. Those that end in ``-*`` take a version, which goes into the label.
SPDX = {
    "gpl": "GPL-*", "lgpl": "LGPL-*", "lgpllr": "LGPLLR", "agpl": "AGPL-*", "gfdl": "GFDL-*", "apache": "Apache-*", "mpl": "MPL-*", "epl": "EPL-*",
    "cddl": "CDDL-*", "cpl": "CPL-*", "ipl": "IPL-*", "cc0": "CC0-*", "cc-by": "CC-BY-*", "cc-by-sa": "CC-BY-SA-*", "cc-by-nd": "CC-BY-ND-*",
    "cc-by-nc": "CC-BY-NC-*", "cc-by-nc-sa": "CC-BY-NC-SA-*", "cc-by-nc-nd": "CC-BY-NC-ND-*", "cc-pddc": "CC-PDDC", "eupl": "EUPL-*",
    "ofl": "OFL-*", "osl": "OSL-*", "afl": "AFL-*", "qpl": "QPL-*", "ecl": "ECL-*", "upl": "UPL-*", "odbl": "ODbL-*", "odc-by": "ODC-By-*",
    "pddl": "PDDL-*", "sspl": "SSPL-*", "busl": "BUSL-*", "elastic": "Elastic-*", "lppl": "LPPL-*", "nasa": "NASA-*", "zpl": "ZPL-*",
    "cecill": "CECILL-* CECILL-B CECILL-C", "mulan": "MulanPSL-*", "artistic": "Artistic-* Artistic-1.0-Perl Artistic-1.0-cl8 ClArtistic",
    "python": "Python-* CNRI-Python", "psf": "PSF-*", "php": "PHP-*", "apsl": "APSL-*", "rpl": "RPL-*", "cpal": "CPAL-*", "oldap": "OLDAP-*",
    "spl": "SPL-*", "npl": "NPL-*", "ncgl-uk": "NCGL-UK-*", "ogl-uk": "OGL-UK-*", "blueoak": "BlueOak-*", "parity": "Parity-*", "polyform":
    "PolyForm-Noncommercial-* PolyForm-Small-Business-*", "etalab": "etalab-*", "cdla-permissive": "CDLA-Permissive-*", "cdla-sharing":
    "CDLA-Sharing-*", "cern-ohl": "CERN-OHL-*", "cern-ohl-p": "CERN-OHL-P-*", "cern-ohl-s": "CERN-OHL-S-*", "cern-ohl-w": "CERN-OHL-W-*",
    "erlpl": "ErlPL-*", "efl": "EFL-*", "lpl": "LPL-*", "oset-pl": "OSET-PL-*", "ucl": "UCL-*", "tapr-ohl": "TAPR-OHL-*", "hippocratic":
    "Hippocratic-*", "liliq": "LiLiQ-P-* LiLiQ-R-* LiLiQ-Rplus-*", "ngpl": "NGPL", "vsl": "VSL-*", "w3c": "W3C W3C-19980720 W3C-20150513",
    "mit": "MIT MIT-Modern-Variant MIT-Wu MIT-open-group MIT-advertising MIT-CMU MIT-enna MIT-feh MIT-Festival MITNFA", "mit-0": "MIT-0",
    "x11": "X11 X11-distribute-modifications-variant", "isc": "ISC ISC-Veillard", "zlib": "Zlib zlib-acknowledgement", "libpng":
    "Libpng libpng-2.0 libpng-1.6.35", "bsl-1.0": "BSL-1.0", "0bsd": "0BSD", "bsd-1-clause": "BSD-1-Clause",
    "bsd-2-clause": "BSD-2-Clause BSD-2-Clause-Patent BSD-2-Clause-Views BSD-2-Clause-FreeBSD BSD-2-Clause-NetBSD BSD-2-Clause-Darwin",
    "bsd-3-clause": "BSD-3-Clause BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-3-Clause-Modification BSD-3-Clause-Attribution BSD-3-Clause-Sun "
                    "BSD-3-Clause-Open-MPI BSD-3-Clause-No-Nuclear-License BSD-3-Clause-No-Military-License BSD-3-Clause-acpica",
    "bsd-4-clause": "BSD-4-Clause BSD-4-Clause-UC BSD-4-Clause-Shortened", "bsd": "BSD-Protection BSD-Source-Code BSD-Attribution-HPND-disclaimer",
    "unlicense": "Unlicense", "wtfpl": "WTFPL", "postgresql": "PostgreSQL", "openssl": "OpenSSL OpenSSL-standalone", "ssleay": "SSLeay-standalone",
    "ncsa": "NCSA", "ms-pl": "MS-PL", "ms-rl": "MS-RL", "ms-lpl": "MS-LPL", "sleepycat": "Sleepycat", "vim": "Vim", "ruby": "Ruby", "json": "JSON",
    "curl": "curl", "tcl": "TCL", "tcp-wrappers": "TCP-wrappers", "hpnd": "HPND HPND-sell-variant", "ntp": "NTP NTP-0", "icu": "ICU", "unicode":
    "Unicode-3.0 Unicode-DFS-2015 Unicode-DFS-2016 Unicode-TOU", "beerware": "Beerware", "bzip2": "bzip2-1.0.5 bzip2-1.0.6", "ftl": "FTL",
    "ijg": "IJG IJG-short", "imagemagick": "ImageMagick", "intel": "Intel Intel-ACPI", "info-zip": "Info-ZIP", "libtiff": "libtiff",
    "fair": "Fair", "fsfap": "FSFAP", "fsful": "FSFUL FSFULLR", "naumen": "Naumen", "multics": "Multics", "motosoto": "Motosoto", "nokia": "Nokia",
    "entessa": "Entessa", "eudatagrid": "EUDatagrid", "frameworx": "Frameworx-1.0", "miros": "MirOS", "xnet": "Xnet", "watcom": "Watcom-1.0",
    "wxwindows": "wxWindows", "xfree86": "XFree86-1.1", "simpl": "SimPL-2.0", "sissl": "SISSL SISSL-1.2", "sgi-b": "SGI-B-1.0 SGI-B-1.1 SGI-B-2.0",
    "saxpath": "Saxpath", "plexus": "Plexus", "sendmail": "Sendmail Sendmail-8.23", "snia": "SNIA", "smlnj": "SMLNJ StandardML-NJ",
    "spencer": "Spencer-86 Spencer-94 Spencer-99", "afmparse": "Afmparse", "adsl": "ADSL", "aml": "AML", "ampas": "AMPAS", "antlr-pd": "ANTLR-PD",
    "bittorrent": "BitTorrent-1.0 BitTorrent-1.1", "borceux": "Borceux", "caldera": "Caldera", "catosl": "CATOSL-1.1", "condor": "Condor-1.1",
    "crossword": "Crossword", "cube": "Cube", "d-fsl": "D-FSL-1.0", "doc": "DOC", "dotseqn": "Dotseqn", "dsdp": "DSDP", "dvipdfm": "dvipdfm",
    "egenix": "eGenix", "glide": "Glide", "gnuplot": "gnuplot", "haskellreport": "HaskellReport", "jasper": "JasPer-2.0", "latex2e": "Latex2e",
    "leptonica": "Leptonica", "linux-openib": "Linux-OpenIB", "mpich2": "mpich2", "mtll": "MTLL", "nlpl": "NLPL", "noweb": "Noweb", "psutils":
    "psutils", "rsa-md": "RSA-MD", "tmate": "TMate", "vostrom": "VOSTROM", "wsuipa": "Wsuipa", "xpp": "xpp", "xskat": "XSkat", "zed": "Zed",
}

#: Sentences of license texts: label, keyword, pattern.
SENTENCES = [
    ("mit", "hereby granted free of charge", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "without restriction including", r"without restriction including without limitation the rights to use copy modify merge publish"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name", r"neither the name of .{1,80}? nor the names of its contributors may be used"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose"),
    ("apache", "apache org licenses", r"www apache org licenses(?: license 2 0)?"),
    ("gpl", "free software you can", r"this program is free software you can redistribute it and or modify it"),
    ("lgpl", "free software you can", r"this library is free software you can redistribute it and or modify it"),
    ("gpl", "gnu org licenses", r"www gnu org licenses"),
    ("mpl", "mozilla org mpl", r"(?:www )?mozilla org mpl"),
    ("cc0", "waived all copyright", r"waived all copyright and related"),
    ("creative-commons", "creativecommons org", r"creativecommons org(?: licenses| publicdomain)"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", "as is without any express", r"this software is provided as is without any express or implied warranty"),
    ("public-domain", "public domain", r"(?:released into|dedicated to|placed in|in) the public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "may not be", r"may not be (?:reproduced|copied|distributed|used) without (?:prior )?(?:written )?permission"),
]

_TAG = b"spdx license identifier"
_VERSION = r"(?: licen[cs]e)?(?: v ?| version | ver )?(?: ?(?P<major>[0-9])(?: (?P<minor>[0-9]))?)?(?P<later> only| or(?: any)? later(?: version)?)?"
_NEEDED = r"(?: v ?| version | ver | )(?P<major>[0-9])(?: (?P<minor>[0-9]))?(?P<later> only| or(?: any)? later(?: version)?)?"


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: bytes
    priority: int
    score: float
    pattern: re.Pattern


def _tag(label: str, name: str) -> Rule:
    """The rule of an SPDX identifier."""
    ws = " ".join(w.decode() for w in words(name.encode()))
    pattern = rf" {_TAG.decode()} {ws}{_VERSION if name.endswith('-*') else ''}(?= )"
    return Rule(f"spdx-{name.lower()}", label, _TAG, 100, 1.0, re.compile(pattern.encode()))


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, highest priority first."""
    out = []
    for kind, priority, score, around in FORMS:
        for i, (label, keyword, name) in enumerate(FAMILIES):
            text = around.replace("{name}", name if kind != "tag" else f"(?:{name})").replace("{version}", _VERSION).replace("{needed}", _NEEDED)
            out.append(Rule(f"{kind}-{label}-{i}", label, keyword.encode(), priority, score, re.compile(rf" {text}(?= )".encode())))
    tags = [_tag(label, name) for label, names in SPDX.items() for name in names.split()]
    out = tags + out  # before the long names behind a tag
    for i, (label, keyword, text) in enumerate(SENTENCES):
        out.append(Rule(f"sentence-{label}-{i}", label, keyword.encode(), 70, 0.9, re.compile(rf" {text}(?= )".encode())))
    return tuple(sorted(out, key=lambda r: -r.priority))


def _label(rule: Rule, m: re.Match) -> str:
    """The family's label, with the version that the match names."""
    g = m.groupdict()
    if not g.get("major"):
        return rule.label
    label = f"{rule.label}-{g['major'].decode()}.{(g.get('minor') or b'0').decode()}"
    return label + "-or-later" * bool(g.get("later") and b"later" in g["later"])


class Cover:
    """Intervals taken so far, only those that lie in no other: sorted by start, they are sorted by end too."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, a: int, b: int) -> bool:
        """Take an interval unless it lies inside one that was taken before."""
        at = bisect_right(self.starts, a)
        if at and self.ends[at - 1] >= b:
            return False
        first = bisect_left(self.starts, a)
        last = bisect_right(self.ends, b)   # those from first to last lie inside the new one
        self.starts[first:max(first, last)] = [a]
        self.ends[first:max(first, last)] = [b]
        return True


def scan(text: bytes) -> tuple[int, list[tuple[str, str, int, int, float]], list[tuple[str, int]]]:
    """Number of words; detections kept (label, rule, start word, end word, score); base phrases (label, start word)."""
    ws = words(text)
    line = b" " + b" ".join(ws) + b" "
    there: dict[bytes, bool] = {}
    raw = []
    for order, rule in enumerate(rules()):
        seen = there.get(rule.keyword)
        if seen is None:
            seen = there[rule.keyword] = rule.keyword in line
        if seen:
            at = 0
            while m := rule.pattern.search(line, at):
                raw.append((order, m.start(), m.end(), rule, _label(rule, m)))
                at = m.start() + 1
    kept: list[tuple[int, int, Rule, str]] = []
    cover = Cover()
    for _, a, b, rule, label in sorted(raw, key=lambda r: (-r[3].priority, r[1] - r[2], r[1], r[0])):
        if cover.add(a, b):
            kept.append((a, b, rule, label))
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    word = lambda pos: int(np.searchsorted(spaces, pos))
    found = sorted((label, rule.name, word(a), word(b), rule.score) for a, b, rule, label in kept)
    base = []
    for phrase, label in BASE.items():
        key, at = f" {phrase} ".encode(), -1
        while (at := line.find(key, at + 1)) >= 0:
            base.append((label, word(at)))
    return len(ws), found, sorted(base, key=lambda x: x[1])


_SCAN = ("struct<n_words:bigint,detections:array<struct<label:string,rule:string,start:bigint,end:bigint,score:double>>,"
         "base:array<struct<label:string,start:bigint>>>")


def with_licenses(df: DataFrame, text: str = "text", out: str = "licenses") -> DataFrame:
    """``df`` plus a struct: number of words, detections with their words, places of the base phrases."""
    detection = pa.struct([("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    place = pa.struct([("label", pa.string()), ("start", pa.int64())])

    @F.arrow_udf(_SCAN)
    def licenses(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            got = [scan(t) for t in utf8(col)]
            yield pa.StructArray.from_arrays(
                [pa.array([n for n, _, _ in got], pa.int64()),
                 pa.array([[dict(zip(("label", "rule", "start", "end", "score"), d)) for d in ds] for _, ds, _ in got], pa.list_(detection)),
                 pa.array([[{"label": x, "start": s} for x, s in bs] for _, _, bs in got], pa.list_(place))],
                ["n_words", "detections", "base"])
    return text_batches(df).withColumn(free_name(df, out), licenses(F.col(quoted(text))))


def joined(labels: Column) -> Column:
    """Distinct labels, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
