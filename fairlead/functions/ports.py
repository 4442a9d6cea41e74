"""Port codes and names, and the codes too small for coarse cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Published port codes and names, kept exactly as the reports use
# them (two codes share the name Leksula).
PORT_NAMES = {
    "CLG": "Calang",
    "KUA": "Kuala Langsa",
    "LSW": "Lhokseumawe/Kreung Geukeh",
    "MLH": "Malahayati",
    "MEQ": "Meulaboh",
    "SBG": "Sabang",
    "SNL": "Singkil",
    "BLW": "Belawan",
    "GNS": "Gunung Sitoli",
    "KTJ": "Kuala Tanjung",
    "LHA": "Lahewa",
    "INL": "Natal/ Sikara-kara",
    "PDD": "Pangkalan Dodek",
    "PKS": "Pangkalan Susu",
    "PTE": "Pulau Tello",
    "SLG": "Sibolga",
    "SRU": "Sirombu",
    "TBE": "Tanjung Beringin",
    "TDA": "Teluk Dalam",
    "LIG": "Teluk Leidong",
    "MPG": "Muara Padang",
    "TBY": "Teluk Bayur",
    "IBI": "Bagan Siapi-api",
    "BKI": "Bengkalis",
    "DUM": "Dumai",
    "ENO": "Kuala Enok",
    "MRT": "Meranti/ Dorak",
    "RCI": "Rengat/Kuala Cinaku",
    "SLJ": "Selat Panjang",
    "SUQ": "Sungai Guntung",
    "TMD": "Tanjung Medang",
    "TLN": "Tembilahan",
    "MSK": "Muara Sabak",
    "TNU": "Talang Duku",
    "ING": "Boom Baru/ Palembang",
    "TGP": "Tanjung Api-Api",
    "BKS": "Pulau Baai",
    "TAG": "Kota Agung/ Batu Balai",
    "PNJ": "Panjang",
    "BLU": "Belinyu",
    "MUO": "Muntok",
    "PGX": "Pangkal Balam",
    "TJQ": "Tanjung Pandan",
    "BUR": "Batam",
    "SKJ": "Sei Kolak Kijang",
    "TJB": "Tanjung Balai Karimun",
    "TBD": "Tanjung Batu Kundur",
    "TNJ": "Tanjung Pinang",
    "IMW": "Marunda",
    "TPR": "Tanjung priok",
    "CBN": "Cirebon",
    "PDR": "Pangandaran/Bojongsalawe",
    "PTM": "Patimban",
    "SRG": "Tanjung Emas",
    "CXP": "Tanjung Intan",
    "BWB": "Banyu Wangi/ Boom",
    "GRE": "Gresik",
    "KAT": "Kalianget",
    "PAZ": "Pasuruan",
    "AEA": "Probolinggo",
    "SUB": "Tanjung Perak",
    "IBP": "Banten",
    "BOA": "Benoa",
    "CEB": "Celukan Bawang",
    "BAD": "Badas",
    "BMU": "Bima",
    "LMR": "Lembar",
    "ENE": "Ende",
    "IPI": "Ippi",
    "KBH": "Kalabahi",
    "LBO": "Labuan Bajo",
    "MOF": "Maumere/ Lorens Say",
    "REO": "Reo",
    "ISA": "Seba",
    "TQP": "Tenau/ Kupang",
    "WGP": "Waingapu",
    "PNK": "Pontianak",
    "SNE": "Sintete",
    "KPE": "Kuala Pembuang",
    "KUM": "Kumai",
    "PLB": "Pangkalan Bun",
    "PMI": "Pegatan Mendawai",
    "PPS": "Pulang Pisau",
    "SMQ": "Sampit",
    "SMA": "Samuda",
    "SAA": "Sukamara",
    "BDJ": "Banjarmasin",
    "SUR": "Satui",
    "BPN": "Balikpapan",
    "LTU": "Lhok Tuan",
    "SGQ": "Sangatta",
    "SKI": "Sangkulirang",
    "TLA": "Tanjung Laut",
    "TRE": "Tanjung Redeb",
    "TTK": "Nunukan / Tunon Taka",
    "MLD": "Tarakan / Malundung",
    "LUK": "Labuhan Uki",
    "MDC": "Manado",
    "BGG": "Banggai",
    "DNA": "Donggala",
    "LUW": "Luwuk",
    "PTL": "Pantoloan",
    "TLI": "Toli-toli",
    "WNQ": "Wani",
    "BAE": "Bajoe",
    "MAK": "Makassar",
    "ARE": "Pare-Pare",
    "YAR": "Selayar/Benteng/Rauf Rahman",
    "BBM": "Bau-Bau/Murhum",
    "KDI": "Kendari/Bungkutoko",
    "KOL": "Kolaka",
    "NGG": "Anggrek",
    "GTO": "Gorontalo",
    "MJU": "Mamuju",
    "AMQ": "Ambon",
    "NDA": "Banda Naira",
    "LQA": "Leksula",
    "NAM": "Leksula",
    "SXK": "Saumlaki",
    "TUA": "Tual",
    "DRA": "Daruba",
    "LBH": "Labuha",
    "SIO": "Soasio/Goto",
    "TEI": "Ternate/ A. Yani",
    "TBO": "Tobelo",
    "BIK": "Biak",
    "DJJ": "Jayapura",
    "MKQ": "Merauke",
    "NBX": "Nabire",
    "FKQ": "Fak-fak",
    "MKW": "Manokwari",
    "SOQ": "Sorong",
    "WSR": "Wasior",
    "ISG": "Sapudi",
    "BIT": "Bitung",
}

# Ports smaller than a cell below resolution 10.
SMALL_PORTS = ("REO", "MPG", "RCI", "PTE", "MRT", "MDC")


def port_name(code: Column | str) -> Column:
    """Name of a port code, null when the code is unknown."""
    pairs = [F.lit(x) for item in PORT_NAMES.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.col(code) if isinstance(code, str) else code)


def without_small_ports(aoi: DataFrame, resolution: int, code: str = "Kode") -> DataFrame:
    """Drop areas that cannot be told apart below resolution 10."""
    if resolution >= 10:
        return aoi
    return aoi.filter(~F.coalesce(F.upper(code).isin(*SMALL_PORTS), F.lit(False)))
