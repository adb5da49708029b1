"""Fixed values and dimension tables.

Everything under "FIXED VALUES" must equal the original pipeline's constants
for results to match; they are stated as they are, in their natural order.
The term -> technique dictionary (275 keys) is not inlined: it is a parameter
(a JSON file path), with the original dictionary shipped unchanged as the
default data file ``seqintel/data/technique_terms.json``.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the original pipeline's constants)
# --------------------------------------------------------------------------

# Attack phases: id, name, description.
PHASES = [
    (0, "Reconocimiento / Preparación", "Identificación de objetivos y preparación de arsenal"),
    (1, "Entrega", "Transmisión del arma al objetivo"),
    (2, "Explotación", "Ejecución del código en el sistema objetivo"),
    (3, "Instalación", "Establecimiento de acceso persistente"),
    (4, "Comando y Control (C2)", "Comunicación con la infraestructura de mando"),
    (5, "Acciones sobre objetivos", "Ejecución del objetivo final del ataque"),
]

# Technique code -> phase id.
TECHNIQUE_PHASE = {
    "T1046": 0, "T1595": 0, "T1082": 0, "T1087.001": 0, "T1087.002": 0, "T1583.001": 0,
    "T1566": 1, "T1566.001": 1, "T1189": 1, "T1195": 1,
    "T1190": 2, "T1204.002": 2, "T1059": 2, "T1059.001": 2, "T1059.004": 2, "T1059.005": 2,
    "T1059.006": 2, "T1059.007": 2, "T1210": 2, "T1218": 2, "T1047": 2, "T1055": 2,
    "T1068": 2, "T1021.001": 2, "T1021.002": 2, "T1021.004": 2, "T1563.001": 2,
    "T1505.003": 3, "T1547.001": 3, "T1543.003": 3, "T1053.005": 3, "T1037": 3,
    "T1542.003": 3, "T1014": 3,
    "T1071": 4, "T1071.001": 4, "T1071.002": 4, "T1071.003": 4, "T1071.004": 4, "T1573": 4,
    "T1573.001": 4, "T1090": 4, "T1572": 4, "T1043": 4,
    "T1003": 5, "T1003.001": 5, "T1003.002": 5, "T1486": 5, "T1041": 5, "T1020": 5,
    "T1498": 5, "T1496": 5, "T1110": 5, "T1557": 5, "T1112": 5, "T1113": 5, "T1123": 5,
    "T1125": 5, "T1056": 5, "T1056.001": 5, "T1555": 5, "T1558.002": 5, "T1558.003": 5,
    "T1134": 5, "T1539": 5, "T1484.001": 5, "T1027": 5, "T1089": 5, "T1552.001": 5,
    "T1490": 5, "T1485": 5,
}

# Phase used when no technique of a non-empty list is known.
DEFAULT_PHASE = 5

# Keyword list, line by line (the first line is a comment in the original file).
KEYWORD_LINES = [
    "# Palabras clave iniciales para detección de amenazas",
    "ransomware", "leak", "data breach", "credential", "access", "initial access",
    "lateral movement", "privilege escalation", "persistence", "c2", "command and control",
    "exfiltration", "encryptor", "decryptor", "locker", "stealer", "malware", "botnet",
    "exploit", "zero-day", "vulnerability", "cve", "phishing kit", "rdp access", "vpn access",
    "Tenebris", "Pitch", "Dread", "BreachForums", "DarkForums", "Exploit.in", "Nulled", "BHF",
    "Cracked", "FreeHacks", "RAMP", "Altenen", "CryptBB",
]

# Salt of the stable anonymisation hash.
ANON_SALT = "titulacion-ti"

# PII patterns, applied in this order (label, Java regex).
PII_PATTERNS = [
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    ("ipv4", r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b"),
    ("onion", r"(?i)\b[a-z2-7]{16,56}\.onion\b"),
    ("btc", r"\b(?:bc1|[13])[a-zA-HJ-NP-Z0-9]{25,62}\b"),
]

# Anonymisation token labels recognised by the text cleaner.
ANON_TOKEN_LABELS = ["USER", "EMAIL", "IPV4", "ONION", "BTC"]
ANON_TOKEN_REPLACEMENT = "[ANONIMIZADO]"

# Timestamp formats tried in order (Spark datetime patterns, unpadded fields
# accepted as strptime does).
TIMESTAMP_FORMATS = [
    "y-M-d H:m:s",
    "y-M-d H:m",
    "d-M-y H:m:s",
    "d/M/y H:m",
    "y/M/d H:m:s",
]

# URL suffixes never followed (case-sensitive).
SKIPPED_URL_SUFFIXES = [".css", ".js", ".png", ".jpg", ".gif", ".pdf", ".svg"]

# Thread id pattern on URLs.
THREAD_URL_PATTERN = r"(?i)(?:thread|topic|t|showtopic|viewtopic)[=/](\d+)"
THREAD_ATTRIBUTES = ["data-thread-id", "data-topic-id", "data-thread"]

# Fetch-outcome rules: requested-path words, landing paths of a ban redirect.
BAN_REQUEST_WORDS = ["thread", "topic", "post", "viewtopic"]
BAN_LANDING_PATHS = ["", "/", "/index.php", "/home", "/forum", "/login"]

# Post extraction selectors (CSS), in the order they are tried.
POST_CONTAINER_SELECTORS = [".post", ".message", "article", ".comment", ".reply",
                            "[data-post-id]", "[id^='post-']", "[class*='post']"]
TITLE_SELECTORS = ["h1", "h2", "title"]
AUTHOR_SELECTORS = [".author", ".username", ".user", "[class*='author']", "[class*='user']"]
TIME_SELECTORS = [".date", ".timestamp", "[class*='time']", "[class*='date']"]
BODY_SELECTORS = [".content", ".body", ".message", ".postbody", "[class*='content']",
                  "[class*='body']"]
QUOTE_SELECTORS = ["blockquote", ".quote", "[class*='quote']"]
UNTITLED = "sin_titulo"
UNKNOWN_USER = "unknown_user"
UNKNOWN_AUTHOR = "usuario_desconocido"

# Report labels.
SHORT_SEQUENCE_NAME = "Secuencia demasiado corta"
SHORT_SEQUENCE_STATUS = "Secuencia demasiado corta (menos de 2 posts)"
NO_DATA_NAME = "Sin datos"
PAGE_RECORDS_KEY = "REGISTROS_PAGINA"

# Phase names used when no phase table is available.
DEFAULT_PHASE_NAMES = ["Reconocimiento", "Entrega", "Explotación", "Instalación", "C2", "Acciones"]

# Predicted phase names counted as critical.
CRITICAL_PHASE_NAMES = ["Acciones sobre objetivos", "Acciones"]

# Persistence classes on the transition diagonal: (lower bound, label).
PERSISTENCE_CLASSES = [(0.7, "muy persistente"), (0.4, "moderadamente persistente")]
TRANSIENT_LABEL = "transitorio"

# Model defaults.
N_STATES = 4
MAX_ITER = 100
TOL = 1e-4
SEED = 42
TEST_RATIO = 0.2
ENTITY_MIN_CONFIDENCE = 0.5
MIN_RAW_BODY = 20
MIN_CLEAN_BODY = 50
MIN_SEQUENCE = 3

# --------------------------------------------------------------------------

DEFAULT_TERMS_PATH = os.path.join(os.path.dirname(__file__), "data", "technique_terms.json")


def phase_df(spark: SparkSession) -> DataFrame:
    """``phase(phase_id, name, description)`` dimension (6 rows)."""
    return spark.createDataFrame(PHASES, "phase_id INT, name STRING, description STRING")


def technique_phase_df(spark: SparkSession, mapping: dict | None = None) -> DataFrame:
    """``technique_phase(technique, phase_id)`` dimension."""
    m = TECHNIQUE_PHASE if mapping is None else mapping
    return spark.createDataFrame(sorted(m.items()), "technique STRING, phase_id INT")


def load_terms_json(path: str | None = None) -> dict[str, list[str]]:
    """Read the term dictionary file (A5). Unlike the original, a failed load raises."""
    with open(path or DEFAULT_TERMS_PATH, encoding="utf-8") as fh:
        data = json.load(fh)
    if not isinstance(data, dict) or not data:
        raise ValueError(f"term dictionary {path!r} is empty or not an object")
    return data
