"""Fixed values of the HR domain, and code-to-label lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------------

# Weekday labels, Monday first: the absence sheets and the timesheets use different ones.
ABSENCE_WEEKDAYS = ["Seg", "Ter", "Quar", "Quin", "Sex", "Sab", "Dom"]
TIMESHEET_WEEKDAYS = ["Seg", "Ter", "Qua", "Qui", "Sex", "Sab", "Dom"]

# Event codes counted as absence in the absenteeism rate.
ABSENCE_CODES = ["007", "008", "009", "010", "011", "012", "013", "014", "020"]

# Event code of an unexcused absence, and the waiver code of a medical certificate.
UNEXCUSED_CODE = "010"
MEDICAL_WAIVER = "001"

# Waiver codes that are no medical absence.
NON_MEDICAL_WAIVERS = ["004", "018", "007", "011", "009", "024", "025"]

# Event codes left out of the overtime and absence report.
REPORT_EXCLUDED_CODES = [
    "027", "003", "110", "112", "011", "017", "007", "033", "009", "038", "123", "044", "048", "127", "060", "064",
    "126", "129", "068", "072", "128", "125", "052", "056", "124", "122", "050", "046", "062", "058", "070", "066",
    "054", "042", "078", "076", "084", "082", "088", "086", "080", "074", "098", "096", "104", "102", "108", "106",
    "100", "094", "013", "019",
]

# Leave types that are never reported.
EXCLUDED_LEAVE_TYPES = ["001", "002", "020"]

# Leave descriptions that the payment rule names, and its answers.
PAID_LEAVE = "LICENCA REMUNERADA"
NEVER_PAID_LEAVES = ["Aposentadoria por Invalidez", "CARCERE"]
MATERNITY_LEAVES = [
    "Afastamento Temporário por Motivo de Licença-Maternidade Pago pela Empresa",
    "Prorrogação do Afastamento Temporário por Motivo de Licença-Maternidade",
]
PAID, NOT_PAID, UNDEFINED = "PAGA", "NÃO PAGA", "UNDEFINED"

# Event descriptions shown on the timesheet: overtime and absence.
OVERTIME_EVENTS = [
    "ADIC.NOTURNO 20%", "SAIDA ANTECIPADA", "HE 50% - IN", "HE 50% - NO", "ADIC.NOTURNO 50%", "HE 70% - NO",
    "HE 70% - IN", "HE 70% - CP", "HE 100% - DSR", "HE 70% - NN", "HE 70% - INN", "HE 100% - ND", "HE 70% - NC",
    "HE 50% - CP", "HE 60% - NO", "ADIC.NOT.EXTRA 50%", "HE 60% - IN", "HE 60% - CP", "HE 50% - NC",
]
ABSENCE_EVENTS = [
    "FALTA", "ATRASO", "SAIDA ANTECIPADA", "ATRASO PER.ANT.NA", "FALTA 1/2 PERIODO", "SAIDA EXPEDIENTE",
    "ATRASO PER.ANT",
]
OVERTIME, ABSENCE, NO_CLASS = "HE", "ABSETEÍSMO", ""

# Hours added to a punch per device time zone; any other zone adds none.
ZONE_OFFSETS = {
    "AMERICA/SAO_PAULO": -3, "AMERICA/PORTO_VELHO": -4, "AMERICA/ARAGUAINA": -3, "EUROPE/MADRID": 2,
    "ATLANTIC/STANLEY": -3, "AMERICA/BOGOTA": -5, "EUROPE/LISBON": 0, "AMERICA/LA_PAZ": -4,
    "AMERICA/PORT_OF_SPAIN": -4, "AMERICA/ARGENTINA/CORDOBA": -3, "AMERICA/ARGENTINA/RIO_GALLEGOS": -3,
    "AMERICA/ARGENTINA/TUCUMAN": -3, "AMERICA/ARGENTINA/BUENOS_AIRES": -3, "AMERICA/SANTIAGO": -4,
    "AMERICA/GUAYAQUIL": -5, "AMERICA/TEGUCIGALPA": -6, "AMERICA/MERIDA": -6, "AMERICA/MEXICO_CITY": -6,
    "AMERICA/HERMOSILLO": -7, "AMERICA/MANAGUA": -6, "AMERICA/PANAMA": -5, "AMERICA/ASUNCION": -4,
    "AMERICA/LIMA": -5, "AFRICA/JOHANNESBURG": 2, "EUROPE/WARSAW": 1, "AMERICA/SANTO_DOMINGO": -4,
    "AMERICA/MONTERREY": -6, "AMERICA/PORT-AU-PRINCE": -5, "AMERICA/CHICAGO": -6, "EUROPE/BERLIN": 1,
    "EUROPE/AMSTERDAM": 1, "AMERICA/MONTEVIDEO": -3, "AMERICA/PHOENIX": -7, "ASIA/AQTOBE": 5,
}

# Constants of an imported punch.
PUNCH_UNIT, PUNCH_COST_CENTRE, PUNCH_LAYOUT = "clockinmobile", "99999999999", 0

# Registry code labels; the key None is the label of any other code.
UNHEALTHY_LABELS = {"1": "Não", "2": "Mínima", "3": "Média", "4": "Máxima", None: "Não"}
HAZARD_LABELS = {"1": "Não", None: "Sim"}
DISABLED_LABELS = {"2": "Não", None: "Sim"}
DISABILITY_LABELS = {
    "0": "Não Possui", "1": "Física", "2": "Auditiva", "3": "Visual", "4": "Intelectual", "5": "Múltipla",
    "6": "Reabilitado", None: "Não Possui",
}
HOUR_BANK_LABELS = {"N": "Não", "S": "Sim", None: "Não"}
MARITAL_LABELS = {
    "C": "CASADO", "D": "DIVOCIADA", "M": "UNIAO ESTAVEL", "Q": "DESQUITADO", "S": "SOLTEIRO", "V": "VIÚVO",
    None: "Não",
}
SCHOOLING_LABELS = {
    "10": "ANALFABETO",
    "20": "SERIE INCOMPLETA (PRIMARIO INCOMPLETO)",
    "25": "SERIE COMPLETA DO 1§ GRAU (PRIMARIO COMPLETO)",
    "30": "PRIMEIRO GRAU (GINASIO) INCOMPLETO",
    "35": "PRIMEIRO GRAU (GINASIO) COMPLETO",
    "40": "SEGUNDO GRAU (COLEGIAL) INCOMPLETO",
    "45": "SEGUNDO GRAU (COLEGIAL) COMPLETO",
    "50": "SUPERIOR INCOMPLETO",
    "55": "SUPERIOR COMPLETO",
    "65": "MESTRADO COMPLETO",
    "75": "DOUTORADO COMPLETO",
    "85": "POS-GRADUACAO/ESPECIALIZACAO",
    "95": "POS-DOUTORADO",
    None: "Não",
}

# Other fixed words of the reports.
NO_PUNCH = "Sem registro"
UNKNOWN_CONTRACT = "Verificar"
YES = "SIM"

# ---- lookups ------------------------------------------------------------------------------------


def label(code: Column, labels: dict) -> Column:
    """Label of a code; the entry under None is the default."""
    known = {k: v for k, v in labels.items() if k is not None}
    pairs = [F.lit(x) for pair in known.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), code)
    default = labels.get(None)
    return found if default is None else F.coalesce(found, F.lit(default))


def zone_offset(zone: Column) -> Column:
    """Hours to add to a punch of a time zone, 0 for an unknown one."""
    return F.coalesce(label(F.upper(F.trim(zone)), ZONE_OFFSETS), F.lit(0))
