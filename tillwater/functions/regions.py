"""Region of a store from the province named at the end of its location."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The provinces of each region.
PROVINCES = {
    "northwest": ["Lai Chau", "Dien Bien", "Son La", "Hoa Binh", "Lao Cai", "Yen Bai"],
    "northeast": [
        "Ha Giang", "Cao Bang", "Bac Kan", "Tuyen Quang", "Lang Son", "Thai Nguyen",
        "Phu Tho", "Bac Giang", "Quang Ninh",
    ],
    "red_river_delta": [
        "Hanoi", "Bac Ninh", "Ha Nam", "Hung Yen", "Hai Duong", "Hai Phong",
        "Nam Dinh", "Ninh Binh", "Thai Binh", "Vinh Phuc",
    ],
    "north_central": [
        "Thanh Hoa", "Nghe An", "Ha Tinh", "Quang Binh", "Quang Tri", "Thua Thien Hue",
    ],
    "south_central": [
        "Da Nang", "Quang Nam", "Quang Ngai", "Binh Dinh", "Phu Yen", "Khanh Hoa",
        "Ninh Thuan", "Binh Thuan",
    ],
    "central_highlands": ["Kon Tum", "Gia Lai", "Dak Lak", "Dak Nong", "Lam Dong"],
    "southeast": [
        "TP Ho Chi Minh", "Binh Duong", "Dong Nai", "Tay Ninh", "Ba Ria Vung Tau", "Binh Phuoc",
    ],
    "southwest": [
        "Long An", "Tien Giang", "Ben Tre", "Tra Vinh", "Vinh Long", "Dong Thap",
        "An Giang", "Can Tho", "Hau Giang", "Kien Giang", "Soc Trang", "Bac Lieu", "Ca Mau",
    ],
}

# Other spellings of a province in the table above.
ALIASES = {"Ha Noi": "Hanoi"}

UNKNOWN_REGION = "unknown"


def accent_table() -> tuple[str, str]:
    """Accented Latin letters and their plain letters, position by position.

    Combining marks come last and have no counterpart, so ``translate`` drops them.
    """
    accented, plain = ["đ", "Đ"], ["d", "D"]
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if base != letter and base.isascii():
            accented.append(letter)
            plain.append(base)
    accented += [chr(code) for code in range(0x0300, 0x0370)]
    return "".join(accented), "".join(plain)


def province_name(location: Column | str) -> Column:
    """Text after the last comma: no accents, single spaces, each word capitalized."""
    text = F.col(location) if isinstance(location, str) else location
    accented, plain = accent_table()
    folded = F.translate(F.substring_index(text, ",", -1), accented, plain)
    return F.initcap(F.trim(F.regexp_replace(folded, r"\s+", " ")))


def provinces_by_region() -> dict[str, list[str]]:
    """The province table in the spelling that :func:`province_name` gives."""
    spelled = {}
    for region, provinces in PROVINCES.items():
        names = provinces + [alias for alias, name in ALIASES.items() if name in provinces]
        spelled[region] = [" ".join(w.capitalize() for w in name.split()) for name in names]
    return spelled


def region_of(location: Column | str) -> Column:
    """Region name, 'unknown' for a province outside the table, NULL for NULL."""
    text = F.col(location) if isinstance(location, str) else location
    entries = [
        F.lit(entry)
        for region, provinces in provinces_by_region().items()
        for province in provinces
        for entry in (province, region)
    ]
    # A lookup in a map evaluates the province once, where CASE branches would repeat it.
    region = F.try_element_at(F.create_map(*entries), province_name(text))
    return F.when(text.isNotNull(), F.coalesce(region, F.lit(UNKNOWN_REGION)))
