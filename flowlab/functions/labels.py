"""Label expressions: native columns, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw label (upper case, non-ASCII as '-') and canonical class.
LABELS = {
    "BENIGN": "BENIGN", "NORMAL": "BENIGN",
    "DOS HULK": "DoS Hulk", "DOS GOLDENEYE": "DoS GoldenEye", "DOS SLOWLORIS": "DoS slowloris", "DOS SLOWHTTPTEST": "DoS Slowhttptest", "DOS/DDOS": "DoS/DDoS",
    "DDOS": "DDoS", "DDOS HOIC": "DDoS", "DDOS LOIC-HTTP": "DDoS", "DDOS LOIC-UDP": "DDoS",
    "FTP-PATATOR": "FTP-Patator", "SSH-PATATOR": "SSH-Patator", "BRUTE FORCE": "Brute Force",
    "WEB ATTACK - BRUTE FORCE": "Web Attack - Brute Force", "WEB ATTACK - XSS": "Web Attack - XSS",
    "WEB ATTACK - SQL INJECTION": "Web Attack - Sql Injection", "WEB ATTACK": "Web Attack - Brute Force",
    "BOT": "Bot", "BOTNET ARES": "Bot", "INFILTRATION": "Infiltration", "INFILTERATION": "Infiltration", "PORTSCAN": "PortScan",
    "SYN": "DDoS", "UDP": "DDoS", "UDP-LAG": "DDoS", "UDPLAG": "DDoS", "TFTP": "DDoS", "MSSQL": "DDoS", "LDAP": "DDoS", "NETBIOS": "DDoS",
    "PORTMAP": "DDoS", "SNMP": "DDoS", "DNS": "DDoS", "WEBDDOS": "DDoS", "DRDOS_DNS": "DDoS", "DRDOS_LDAP": "DDoS", "DRDOS_MSSQL": "DDoS",
    "DRDOS_NTP": "DDoS", "DRDOS_NETBIOS": "DDoS", "DRDOS_SNMP": "DDoS", "DRDOS_UDP": "DDoS", "HEARTBLEED": "Heartbleed",
}

# Canonical class and the family shown for it.
FAMILIES = {
    "DoS Hulk": "DoS", "DoS GoldenEye": "DoS", "DoS Slowhttptest": "DoS", "DoS slowloris": "DoS",
    "SSH-Patator": "Brute Force", "FTP-Patator": "Brute Force", "Web Attack - Brute Force": "Brute Force", "Web Attack": "Brute Force",
    "Web Attack - XSS": "XSS", "Web Attack - Sql Injection": "Sql Injection", "Botnet": "Bot",
}

# Verdict synonyms.
ATTACK_VERDICTS = ("confirmed", "confirm", "attack", "true_positive", "tp", "malicious", "escalated", "escalate")
BENIGN_VERDICTS = ("false_positive", "fp", "benign", "clean", "normal", "dismissed", "dismiss")


def lookup(mapping: dict, key: Column) -> Column:
    """mapping[key] as a map literal; null where there is none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def label_key(raw: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(raw), r"[^\x00-\x7E]", "-"))


def normalise_label(raw: Column, mapping: dict[str, str] | None = None) -> Column:
    """Canonical class of a raw label; unknown labels stay as they are, trimmed."""
    return F.coalesce(lookup(mapping or LABELS, label_key(raw)), F.trim(raw))


def is_attack(label: Column, benign: str = "BENIGN") -> Column:
    """0 for the benign label (case and outer space do not matter), else 1; null labels are attacks, as unknown."""
    return F.when(F.upper(F.trim(label)) == benign.upper(), 0).otherwise(1)


def one_vs_rest(label: Column, target: str) -> Column:
    return F.when(label == target, 1).otherwise(0)


def attack_family(label: Column, families: dict[str, str] | None = None) -> Column:
    """Display family of a class; null and blank are Unknown."""
    text = F.trim(F.coalesce(label, F.lit("")))
    return F.when(text == "", "Unknown").otherwise(F.coalesce(lookup(families or FAMILIES, text), text))


def verdict(raw: Column) -> Column:
    """1 attack, 0 benign, null unusable. Numbers above 0.5 are attacks."""
    text = F.regexp_replace(F.lower(F.trim(raw.cast("string"))), "[ -]", "_")
    number = raw.cast("string").try_cast("double")
    return (
        F.when(number > 0.5, 1).when(number.isNotNull() & ~F.isnan(number), 0).when(text.isin(*ATTACK_VERDICTS), 1).when(text.isin(*BENIGN_VERDICTS), 0)
    )
