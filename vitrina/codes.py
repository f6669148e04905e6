"""Fixed values of the feature job.

These code lists must equal the ones the original forecasting batch uses, or
the flags and filters give other rows.  They are stated once, in the order the
batch writes them, and every operator reads them from here.
"""

# --- fixed values (domain constants, do not edit) -------------------------

# Offer-type codes kept in the base (closed and open campaigns).
OFFER_CODES_ALL = (
    "003", "007", "008", "009", "010", "011", "012", "013", "014", "015", "017",
    "018", "019", "029", "033", "035", "036", "038", "039", "043", "044", "047",
    "048", "049", "060", "064", "106", "108", "114", "115", "116", "123",
)
# Offer types sold through the catalogue.
OFFER_CODES_CATALOGUE = (
    "007", "008", "010", "011", "012", "013", "014", "015", "017", "018", "019",
    "033", "036", "039", "043", "044", "106", "114", "116",
)
# Offer types sold through the magazine.
OFFER_CODES_MAGAZINE = (
    "003", "009", "029", "035", "038", "047", "048", "049", "060", "064", "108",
    "115", "123",
)
# Set offer types: a set at the lowest price triggers price averaging.
OFFER_CODES_SET = ("008", "035", "036", "060", "049", "012", "038", "039")
# Gift offer types.
OFFER_CODES_GIFT = ("007", "029", "048")
# Macro tactics.
OFFER_CODES_MACRO = (
    "001", "003", "004", "005", "006", "009", "010", "011", "012", "013", "014",
    "025", "029", "033", "035", "044", "048", "049", "060", "064", "106", "108",
    "114", "115", "116", "117", "123",
)
# Detailed tactics.
OFFER_CODES_DETAIL = (
    "007", "008", "016", "017", "018", "019", "036", "038", "039", "043", "047",
)
# One output flag per offer type: (column name, code), in output order.
OFFER_TYPE_FLAGS = (
    ("TO_003_OfertaConsultora", "003"),
    ("TO_007_Apoyados", "007"),
    ("TO_008_Especiales", "008"),
    ("TO_011_OfertasPrincipales", "011"),
    ("TO_013_Especiales", "013"),
    ("TO_014_BloquePosterContra", "014"),
    ("TO_015_Especiales", "015"),
    ("TO_017_Especiales", "017"),
    ("TO_018_Especiales", "018"),
    ("TO_019_RestoLinea", "019"),
    ("TO_029_OfertaConsultora", "029"),
    ("TO_033_PromocionPropia", "033"),
    ("TO_035_FechasEspeciales", "035"),
    ("TO_036_FechasEspeciales", "036"),
    ("TO_043_Especiales", "043"),
    ("TO_048_OfertaConsultora", "048"),
    ("TO_049_OfertaConsultora", "049"),
    ("TO_060_OfertaConsultora", "060"),
    ("TO_106_Oferta1x2x3x", "106"),
    ("TO_116_PromocionInsuperable", "116"),
    ("TO_123_OfertaConsultora", "123"),
)
# Printed catalogues a tactic must be laid out in.
CATALOGUES = ("REVISTA BELCORP", "CATALOGO CYZONE", "CATALOGO EBEL/LBEL", "CATALOGO ESIKA")
MAGAZINE = "REVISTA BELCORP"
# Page placements and sides.
PLACEMENT_FLAGS = (
    ("UbicacionCaratula", ("CARATULA", "CARATULA Y CONTRACARATULA")),
    ("UbicacionContracaratula", ("CONTRA CARATULA", "CARATULA Y CONTRACARATULA")),
    ("UbicacionPoster", ("POSTER",)),
    ("UbicacionInserto", ("INSERTO",)),
    ("UbicacionPrimeraPagina", ("PRIMERA PAGINA (2 Y 3)",)),
    ("UbicacionOtros", ("OTROS / CUALQUIER PAGINA", "")),
)
SIDE_FLAGS = (
    ("LadoDerecho", "LADO DERECHO"),
    ("LadoAmbos", "EN AMBOS LADOS"),
    ("LadoIzquierdo", "LADO IZQUIERDO"),
)
# Seasonal flags by the two-digit campaign suffix.
SEASON_FLAGS = (
    ("FlagDiaPadre", ("09",)),
    ("FlagDiaMadre", ("07",)),
    ("FlagNavidad", ("17", "18")),
    ("FlagC01", ("01",)),
    ("FlagC02", ("02",)),
)
# Product categories the job can run for; the first is the default.
CATEGORIES = (
    "CUIDADO PERSONAL", "TRATAMIENTO FACIAL", "FRAGANCIAS", "TRATAMIENTO CORPORAL", "MAQUILLAJE",
)
COSMETICS_UNIT = "COSMETICOS"
CATALOGUE_PROFIT_TYPE = "01"
DUMMY_SALE_CODE = "00000"
NO_EXPOSURE_TEXT = "SIN EXPOSICION"
# Country codes recoded to their usual form.
COUNTRY_RECODE = (("S2", "SV"), ("G2", "GT"))
DOLLAR_COUNTRY = "BO"
# Support groups with fewer distinct supported products than this count.
SUPPORT_LIMIT = 10
# Magazine pages at or above this number are reactions, not tactics.
MAGAZINE_PAGE_LIMIT = 100

# Output columns (78) in their order.
OUTPUT_COLUMNS = [
    "CodPais", "AnioCampana", "DesMarca", "CodCUC", "CodCategoria", "DesCategoria", "N_Records_SKU",
    "NCampaign", "Development", "RealNroPedidos", "PrecioOfertaProm", "PrecioOfertaMin",
    "PrecioOfertaMinAlCuadrado", "PrecioOfertaMinInverso", "PrecioOfertaMax", "PrecioOfertaMaxAlCuadrado",
    "PrecioOfertaMaxInverso", "PrecioNormalMN", "NroTipoOfertas", "NroTipoOfertasCatalogo",
    "NroTipoOfertasRevista", "RealUUDemandadas", "PUP", "ExposicionMin", "ExposicionMinRaizCuadrada",
    "ExposicionMax", "ExposicionMaxRaizCuadrada", "ExposicionTotal", "MaxDescuento", "MaxDescuentoCuadrado",
    "FlagDescuentoMayor60", "FlagDescuentoMayor70", "MaxDescuentoRevista", "MaxDescuentoCatalogo",
    "FactorDemoCatalogo", "FlagMaxDescuentoRevista",
    *[n for n, _ in PLACEMENT_FLAGS], *[n for n, _ in SIDE_FLAGS],
    "NroPaginas", "FotoProducto", "FotoModelo", "FlagDiscover", "FlagTacticaMacro", "FlagTacticaDetallada",
    *[n for n, _ in SEASON_FLAGS], "FlagRegalo", *[n for n, _ in OFFER_TYPE_FLAGS],
]
