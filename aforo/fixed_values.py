"""Code lists and word lists of the customs reports, passed to the operators as parameters."""

from __future__ import annotations

# Every constant in this file must equal the published report rules, or the reports
# would select other rows.

# Currency number in the declarations -> currency code.
CURRENCY_NUMBERS = {6: "cad", 13: "usd", 36: "aud", 142: "eur", 200: "clp"}

# Currencies with a rate column of their own.
RATE_CURRENCIES = ("usd", "eur", "cad", "aud")

# Days of the naive rate forecast, and what decides between them.
FORECAST_DAYS = 730
FORECAST_DAYS_SHORT = 30
FORECAST_LAG_DAYS = 45

# Replacement of missing codes.
IMPORT_SENTINELS = {"MEDIDA": 999}
EXPORT_SENTINELS = {
    "PAISCIATRANSP": 999,
    "MONEDA": 900,
    "ADUANA": -1,
    "VIATRANSPORTE": -1,
    "UNIDADMEDIDA": -1,
}

# Columns that hold amounts as locale text.
IMPORT_AMOUNTS = (
    "CIF", "CIF_ITEM", "FOB", "CANT_MERC", "PRE_UNIT", "FLETE", "MON_OTRO", "SEGURO", "TOT_PESO",
)
EXPORT_AMOUNTS = (
    "CANTIDADMERCANCIA", "FOBUS", "FOBUNITARIO", "VALORFLETE", "TOTALVALORFOB", "PESOBRUTOTOTAL",
    "VALORLIQUIDORETORNO", "VALORCLAUSULAVENTA",
)

# Columns that hold integer codes.
IMPORT_CODES = (
    "ADU", "CL_COMPRA", "TIPO_DOCTO", "MONEDA", "PA_ORIG", "PA_ADQ", "CODPAISCON", "CODPAISCIA",
    "PTO_EMB", "PTO_DESEM", "VIA_TRAN", "MEDIDA",
)
EXPORT_CODES = ("ADUANA", "MONEDA", "PAISCIATRANSP", "VIATRANSPORTE", "UNIDADMEDIDA", "FECHAACEPT")

# Columns that make up the full description.
IMPORT_DESCRIPTION = ("DNOMBRE", "DMARCA", "DVARIEDAD", "DOTRO1", "DOTRO2")
EXPORT_DESCRIPTION = (
    "NOMBRE", "ATRIBUTO1", "ATRIBUTO2", "ATRIBUTO3", "ATRIBUTO4", "ATRIBUTO5", "ATRIBUTO6",
)

# The eight code dimensions; each file is aduana_codigos_<name>.csv.
DIMENSIONS = (
    "aduana", "clausula_compra", "documento_ingreso", "monedas", "pais", "puertos", "transporte",
    "unidad",
)

# Product classes: tariff prefixes and name keywords.
WHEAT_CLASS = "trigo"
WHEAT_PREFIXES = ("0910", "1001", "1002", "1003", "1004", "1005", "1006", "1007")
WHEAT_WORDS = ("TRIGO", "CENTENO", "MAIZ", "CEBADA")
CANOLA_CLASS = "canola"
CANOLA_PREFIXES = ("23063000", "23064100", "23064900", "15141100", "23064000", "1205")
CANOLA_WORDS = ("CANOLA", "RAPS", "COLZA", "NABO")

# Keyword that makes a product oil, and the two sub-types.
OIL_WORD = "ACEITE"
OIL_TYPE = "aceite"
OTHER_TYPE = "otro"

# Keyword exclusions per column.
IMPORT_EXCLUDED_WORDS = {
    "DNOMBRE": (
        "SOLUCION", "BENZOATO", "VESTIDO", "FERTILIZANTE", "EMPAQUE", "MEZCLA", "ARROZ",
        "GALLETAS", "PICKLES", "ROASTED ONION", "CANNABOOST", "MARGARINA", "ANILINAS", "CAPILAR",
        "FETTFAX", "HIDROFOBICA",
    ),
    "DESOBS1": ("BOTELLAS", "FIDEOS", "PALOMITA", "CONDIMENTO", "CABLE", "PASTA"),
    "DMARCA": ("SAZONADOR",),
}
EXPORT_EXCLUDED_WORDS = {
    "NOMBRE": (
        "SOLUCION", "VESTIDO", "FERTILIZANTE", "EMPAQUE", "MEZCLA", "NESTUM", "NESTLE", "CERVEZA",
        "POLERA", "FALDA", "CAMISA", "LAPICES", "BOLIGRAFOS", "BOVINOS",
    ),
    "ATRIBUTO1": ("BOTELLAS", "FIDEOS", "PALOMITA", "CONDIMENTO", "CABLE", "PASTA"),
}

# Further words that keep an import out of the report, on DESOBS1.
IMPORT_REPORT_EXCLUDED_WORDS = ("PIEZAS", "UNIDAD", "CAJA", "CIENTOS", "KIT")

# Spellings that mark seed for sowing, and the quantity below which a row counts as seed.
SEED_PATTERNS = ("SIEMB", "SIEBRA", "SIEM B", "SIE MB", "SI EM", "S IEM")
SEED_QUANTITY_BELOW = 5000

# Report scope.
MIN_QUANTITY = 2
REPORT_MIN_QUANTITY = 100
REPORT_TRANSPORTS = (7, 1)
REPORT_UNIT = 6
REPORT_MIN_FOB_USD = 1000

# Label of the all-country series.
ALL_COUNTRIES = "TODOS"

# Tariff codes left out of the import view.
IMPORT_EXCLUDED_TARIFFS = (
    "7129099", "9109100", "10063010", "10063020", "10063090", "19041000", "19059000", "19059090",
    "20019090", "20059990", "21039010", "21039090", "21061010", "21069090", "22029960", "22030000",
    "22087000", "29163190", "29214100", "30043212", "30043910", "31010000", "31051090", "32159000",
    "33051010", "33051020", "33059020", "33059090", "33074990", "34022090", "38099190", "39031990",
    "39173290", "39231010", "39231090", "39232100", "39232990", "39239090", "39241000", "39269090",
    "40169390", "40169900", "42021100", "42022210", "42022220", "42023900", "42029220", "42031000",
    "42050000", "44079110", "44149000", "44219990", "46021900", "47062000", "47069100", "48131000",
    "48139000", "48193000", "48236990", "48239099", "49070090", "49111010", "56031210", "56041000",
    "56075090", "56090000", "58063200", "61091011", "61099021", "61124100", "61143000", "61178000",
    "62045300", "62045900", "62082100", "62171000", "63023200", "63079000", "63079090", "64019200",
    "64029990", "64039110", "64041900", "64051000", "69072290", "70109010", "72202000", "73202000",
    "73239200", "73269000", "82019000", "82055900", "82100000", "83099020", "84198100", "84199000",
    "84224000", "84303900", "84323100", "84323900", "84328000", "84335200", "84335990", "84339000",
    "84368000", "84378000", "84382000", "84386000", "84388090", "84713010", "84713020", "85068090",
    "85094011", "85094019", "85098000", "85166090", "85167990", "85177000", "85182900", "85183090",
    "85258020", "85369019", "85437090", "85442000", "85444200", "87082990", "90049080", "90160000",
    "90259000", "90262090", "91132000", "91139000", "92099400", "94016910", "94054090", "95030090",
    "95049000", "95069100", "95069110", "95069910", "95069990",
)

# Tariff codes left out of the export view.
EXPORT_EXCLUDED_TARIFFS = (
    "10063010", "10063020", "10063090", "19041000", "19059090", "22030000", "29163190", "29214100",
    "30043212", "30043910", "31010000", "31051090", "32159000", "33051010", "33051020", "33059020",
    "33059090", "33074990", "38099190", "39231010", "39231090", "39232990", "39239090", "39241000",
    "39269090", "40169390", "42022210", "42022220", "42023900", "42029220", "42050000", "44079110",
    "44219990", "46021900", "47062000", "47069100", "48131000", "48236990", "48239099", "49070090",
    "49111010", "56041000", "56075090", "58063200", "61091011", "61124100", "62045900", "62082100",
    "62171000", "63079000", "64019200", "64039110", "64041900", "69072290", "70109010", "72202000",
    "73239200", "73269000", "82019000", "82100000", "84198100", "84199000", "84224000", "84303900",
    "84323100", "84323900", "84328000", "84335200", "84335990", "84339000", "84368000", "84378000",
    "84382000", "84386000", "84388090", "84713010", "84713020", "85068090", "85094011", "85094019",
    "85098000", "85166090", "85167990", "85177000", "85182900", "85183090", "85258020", "85369019",
    "85437090", "85442000", "85444200", "87082990", "90049080", "90160000", "90262090", "91132000",
    "91139000", "94016910", "95030090", "95049000", "95069110", "95069990", "90159000", "62114300",
)
