"""Lookup tables, as plain data."""

from __future__ import annotations

# Case classes and what they are written as, without accents; a dot may be there or not, with spaces after it.
CLASSES = {
    "EDcl": ["embargos de declaracao", "e.d.cl", "eds", "ed"],
    "EDv": ["no embargos de divergencia", "nos embargos de divergencia", "embargos de divergencia", "edv"],
    "AREsp": ["agravo em recurso especial", "a.resp", "aresp", "arespel"],
    "REspe": ["recurso especial eleitoral", "respe."],
    "REsp": ["recurso especial", "rec.esp.", "r.esp.", "resp."],
    "RHC": ["recurso em habeas corpus", "rhc"],
    "RMS": ["recurso em mandado de seguranca", "rms"],
    "SLS": ["suspensao de liminar e de sentenca", "sls"],
    "AI": ["agravo de instrumento", "ai"],
    "AgInt": ["agravo interno", "ag.int.", "agint"],
    "AgRg": ["agravo regimental", "ag.r.", "ag.reg.", "ag.regimental", "agrg", "agr"],
    "AgREsp": ["agresp"],
    "Rcl": ["reclamacao", "recl.", "rcl"],
    "HC": ["habeas corpus", "h.c."],
    "APL": ["apelacao", "apl"],
    "RSE": ["rse", "recurso em sentido estrito"],
    "RE": ["recurso extraordinario", "re."],
    "AR": ["acao rescisoria", "ar"],
    "RR": ["recurso de revista", "rr"],
    "ARR": ["arr"],
    "AgARR": ["agarr"],
    "Rp": ["representacao", "rp"],
    "EIN": ["embargos infringentes e de nulidade", "embargos infringentes", "ein"],
    "ROE": ["recurso ordinario eleitoral", "roe"],
    "RO": ["recurso ordinario", "ro"],
    "CautInom": ["cautelar inominada criminal", "cautelar inominada", "cautinom"],
    "CJ": ["conflito de jurisdicao", "conflito de competencia", "cj"],
    "CorPar": ["correicao parcial militar", "correicao parcial", "corpar"],
    "Pet": ["peticao", "pet"],
    "PC": ["prestacao de contas"],
    "LT": ["lista triplice", "lt"],
    "AP": ["acao penal", "ap"],
    "MS": ["mandado de seguranca", "ms"],
    "ADI": ["acao direta de inconstitucionalidade", "adi"],
    "AC": ["acao cautelar", "ac"],
    "DCG": ["dcg"],
    "AIRR": ["agravo de instrumento em recurso de revista", "airr"],
    "RRAG": ["rrag"],
    "ROT": ["recurso ordinario trabalhista", "rot"],
    "IRR": ["incidente de recursos de revista repetitivos", "incidente de recurso de revista repetitivo", "irr"],
    "ACO": ["acao civel originaria", "aco"],
    "ADC": ["acao declaratoria de constitucionalidade", "acao direta de constitucionalidade", "adc"],
    "ADO": ["acao direta de inconstitucionalidade por omissao", "ado"],
    "ADPF": ["arguicao de descumprimento de preceito fundamental", "adpf"],
    "ARE": ["recurso extraordinario com agravo", "are"],
    "EREsp": ["embargos de divergencia em recurso especial", "eresp"],
}

# Tokens within labour-court numbers, and the classes they stand for.
LABOUR_TOKENS = {
    "a": ["Ag"], "ag": ["AgRg"], "agr": ["AgRg"], "agrg": ["AgRg"], "agint": ["AgInt"], "e": ["E"], "ed": ["EDcl"], "edcl": ["EDcl"], "emb": ["EMB"], "edciv": ["EDCIV"],
    "rr": ["RR"], "airr": ["AIRR"], "arr": ["ARR"], "rrag": ["RRAG"], "rot": ["ROT"], "irr": ["IRR"], "agarr": ["AgRg", "ARR"], "agairr": ["AgRg", "AIRR"], "agrr": ["AgRg", "RR"],
}

# Laws and what they are called, without accents.
LAWS = {
    "CF-1988": ["constituicao federal", "constituicao fedcral", "constituicao da republica", "constituicao da republica federativa", "cf", "cf/88", "cf/1988"],
    "LEI-13105-2015": ["cpc", "codigo de processo civil", "lei 13105/2015", "lei 13.105/2015"],
    "DL-5452-1943": ["clt", "consolidacao das leis do trabalho"],
    "LEI-8078-1990": ["cdc", "codigo de defesa do consumidor"],
    "DL-1001-1969": ["cpm", "codigo penal militar"],
    "LEI-4737-1965": ["codigo eleitoral"],
    "LEI-10406-2002": ["codigo civil", "cc"],
    "DL-3689-1941": ["cpp", "codigo de processo penal"],
    "LC-64-1990": ["lei complementar 64/1990", "lc 64/1990"],
    "LEI-9504-1997": ["lei 9504/1997", "lei 9.504/1997"],
    "LEI-13467-2017": ["lei 13467/2017", "lei 13.467/2017"],
}

# States and their names, without accents.
STATES = {
    "AC": "acre", "AL": "alagoas", "AP": "amapa", "AM": "amazonas", "BA": "bahia", "CE": "ceara", "DF": "distrito federal", "ES": "espirito santo", "GO": "goias", "MA": "maranhao",
    "MT": "mato grosso", "MS": "mato grosso do sul", "MG": "minas gerais", "PA": "para", "PB": "paraiba", "PR": "parana", "PE": "pernambuco", "PI": "piaui", "RJ": "rio de janeiro",
    "RN": "rio grande do norte", "RS": "rio grande do sul", "RO": "rondonia", "RR": "roraima", "SC": "santa catarina", "SP": "sao paulo", "SE": "sergipe", "TO": "tocantins",
}

# Courts and how their names are spelled out, without accents.
COURTS = {
    "STF": ["supremo tribunal federal", "suprema corte"],
    "STJ": ["superior tribunal de justica"],
    "TST": ["tribunal superior do trabalho"],
    "TSE": ["tribunal superior eleitoral"],
    "STM": ["superior tribunal militar"],
}

# Words that may be repaired when m was read as rn or rn as m.
REPAIRABLE = (
    "súmula súmulas súm sumular sumulares ministro ministra ministros ministras min stm supremo em embargos mandado instrumento interno interna regimental reclamação reclamações "
    "competência inominada criminal liminar militar cautinom ms rms com omissão descumprimento fundamental complementar cpm consumidor tema temas"
).split()

# Phrases that refer to something without naming it, without accents.
VAGUE = ["jurisprudencia pacifica", "entendimento sumulado", "artigo correspondente", "orientacao jurisprudencial da corte superior", "dispositivo legal de regencia"]

# Prefixes of laws' keys, titles before names, and lines of headers.
LAW_KINDS = {"decreto-lei": "DL", "decreto lei": "DL", "lei complementar": "LC", "lc": "LC", "lei": "LEI"}
TITLES = ["ministro", "ministra", "min", "dr", "dra", "des", "juiz", "juiza", "juizo"]
HEADER_LABELS = (
    "processo autos protocolo memorial oficio impetrante paciente apelante apelado agravante agravado assistido autoridade relator reclamante reclamada recorrente recorrido autor re".split()
) + ["valor da causa"]
