"""Declared tables, statistic families and the league list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    nullable: bool = False
    default: object = None


_TYPES = {"S": T.StringType(), "L": T.LongType(), "D": T.DoubleType(), "DT": T.DateType()}


def declare(text: str) -> tuple[Field, ...]:
    """Fields from lines like ``Name:L``, ``Name:S?`` (nullable), ``Name:L=0`` (default)."""
    fields = []
    for item in (part.strip() for part in text.replace("\n", ",").split(",")):
        if not item:
            continue
        name, _, spec = item.rpartition(":")
        spec, _, default = spec.partition("=")
        fields.append(
            Field(name, _TYPES[spec.rstrip("?")], spec.endswith("?"), int(default) if default else None)
        )
    return tuple(fields)


def struct_of(fields: tuple[Field, ...]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.type, True) for f in fields])


# Column names, types, nullability and defaults of the declared tables.
MATCH_SUMMARY = declare(
    """MatchURL:S, League:S, Match_Date:DT, Matchweek:S, Home_Team:S, Home_Formation:S?, Home_Score:L=0,
    Home_xG:D?, Home_Goals:S?, Home_Yellow_Cards:L, Home_Red_Cards:L, Away_Team:S, Away_Formation:S?,
    Away_Score:L?=0, Away_xG:D?, Away_Goals:S?, Away_Yellow_Cards:L, Away_Red_Cards:L, Game_URL:S, Team:S,
    Home_Away:S, Event_Time:S, Is_Pens:S, Event_Half:S, Event_Type:S, Event_Players:S, Score_Progression:S?,
    Penalty_Number:S?, Competition_Name:S, Gender:S, Country:S, Tier:S, Season_End_Year:L"""
)
MATCH_RESULTS = declare(
    """Competition_Name:S, Gender:S, Country:S, Season_End_Year:L, Tier:S, Round:S?, Wk:L?, Day:S?, Date:DT,
    Time:S?, Home:S, HomeGoals:L?, Home_xG:D?, Away:S, AwayGoals:L?, Away_xG:D?, Attendance:L?, Venue:S?,
    Referee:S?, Notes:S?, MatchURL:S?"""
)
MATCH_SHOOTING = declare(
    """MatchURL:S, Date:DT, Squad:S, Home_Away:S, Match_Half:S, Minute:L, Player:S, Player_Href:S, xG:D, PSxG:D,
    Outcome:S, Distance:D, Body Part:S, Notes:S, Player_SCA_1:S, Event_SCA_1:S, Player_SCA_2:S, Event_SCA_2:S,
    Competition_Name:S, Gender:S, Country:S, Tier:S, Season_End_Year:L"""
)
WAGES = declare("Comp:S, Season:S, Team:S, Player:S, WeeklyWageGBP:D, AnnualWageGBP:D")

# The seven statistic families, in joining order. All columns are
# long but for those listed in DOUBLE_STATS.
FAMILY_COLUMNS = {
    "summary": """Gls, Ast, PK, PKatt, Sh, SoT, CrdY, CrdR, Touches, Tkl, Int, Blocks, xG_Expected, npxG_Expected,
        xAG_Expected, SCA_SCA, GCA_SCA, Cmp_Passes, Att_Passes, Cmp_percent_Passes, PrgP_Passes, Carries_Carries,
        PrgC_Carries, Att_Take_Ons, Succ_Take_Ons""",
    "keeper": """SoTA_Shot_Stopping, GA_Shot_Stopping, Saves_Shot_Stopping, Save_percent_Shot_Stopping,
        PSxG_Shot_Stopping, Cmp_Launched, Att_Launched, Cmp_percent_Launched, Att (GK)_Passes, Thr_Passes,
        Launch_percent_Passes, AvgLen_Passes, Att_Goal_Kicks, Launch_percent_Goal_Kicks, AvgLen_Goal_Kicks,
        Opp_Crosses, Stp_Crosses, Stp_percent_Crosses, Player_NumOPA_Sweeper, AvgDist_Sweeper""",
    "passing": """Att, Live_Pass_Types, Dead_Pass_Types, FK_Pass_Types, TB_Pass_Types, Sw_Pass_Types, Crs_Pass_Types,
        TI_Pass_Types, CK_Pass_Types, In_Corner_Kicks, Out_Corner_Kicks, Str_Corner_Kicks, Cmp_Outcomes, Off_Outcomes,
        Blocks_Outcomes, Cmp_Total, Att_Total, Cmp_percent_Total, TotDist_Total, PrgDist_Total, Cmp_Short, Att_Short,
        Cmp_percent_Short, Cmp_Medium, Att_Medium, Cmp_percent_Medium, Cmp_Long, Att_Long, Cmp_percent_Long, Ast, xAG,
        xA, KP, Final_Third, PPA, CrsPA, PrgP""",
    "passing_types": """Att, Live_Pass_Types, Dead_Pass_Types, FK_Pass_Types, TB_Pass_Types, Sw_Pass_Types,
        Crs_Pass_Types, TI_Pass_Types, CK_Pass_Types, In_Corner_Kicks, Out_Corner_Kicks, Str_Corner_Kicks,
        Cmp_Outcomes, Off_Outcomes, Blocks_Outcomes""",
    "possession": """Touches_Touches, Def Pen_Touches, Def 3rd_Touches, Mid 3rd_Touches, Att 3rd_Touches,
        Att Pen_Touches, Live_Touches, Att_Take_Ons, Succ_Take_Ons, Succ_percent_Take_Ons, Tkld_Take_Ons,
        Tkld_percent_Take_Ons, Carries_Carries, TotDist_Carries, PrgDist_Carries, PrgC_Carries, Final_Third_Carries,
        CPA_Carries, Mis_Carries, Dis_Carries, Rec_Receiving, PrgR_Receiving""",
    "defense": """Tkl_Tackles, TklW_Tackles, Def 3rd_Tackles, Mid 3rd_Tackles, Att 3rd_Tackles, Tkl_Challenges,
        Att_Challenges, Tkl_percent_Challenges, Lost_Challenges, Block_Blocks, Sh_Blocks, Pass_Blocks, Int, Tkl+Int,
        Clr, Err""",
    "misc": """CrdY, CrdR, 2CrdY, Fls, Fld, Off, Crs, Int, TklW, PKwon, PKcon, OG, Recov, Won_Aerial_Duels,
        Lost_Aerial_Duels, Won_percent_Aerial_Duels""",
}
DOUBLE_STATS = set(
    """xG_Expected npxG_Expected xAG_Expected Cmp_percent_Passes Save_percent_Shot_Stopping PSxG_Shot_Stopping
    Cmp_percent_Launched Launch_percent_Passes AvgLen_Passes Launch_percent_Goal_Kicks AvgLen_Goal_Kicks
    Stp_percent_Crosses AvgDist_Sweeper Cmp_percent_Total Cmp_percent_Short Cmp_percent_Medium Cmp_percent_Long xAG xA
    Succ_percent_Take_Ons Tkld_percent_Take_Ons Tkl_percent_Challenges Won_percent_Aerial_Duels""".split()
)
FAMILIES = tuple(FAMILY_COLUMNS)

# Alternate spellings of defence columns.
DEFENSE_ALIASES = {
    "Def.3rd_Tackles": "Def 3rd_Tackles",
    "Mid.3rd_Tackles": "Mid 3rd_Tackles",
    "Att.3rd_Tackles": "Att 3rd_Tackles",
    "Tkl.Int": "Tkl+Int",
}

# The columns that describe a match, a team row and a player row.
MATCH_KEYS = """Country Gender Tier Season_End_Year MatchURL Match_Date League Matchweek Home_Team Home_Formation
    Home_Score Home_xG Home_Goals Home_Red_Cards Home_Yellow_Cards Away_Team Away_Formation Away_Score Away_xG
    Away_Goals Away_Red_Cards Away_Yellow_Cards Game_URL""".split()
PLAYER_KEYS = """MatchURL Team Home_Away Player Player_Href Player_Num Pos Nation Age Min Gender Country Tier
    Season_End_Year""".split()
PERSON_COLUMNS = "Player Player_Num Pos Nation Age Player_Href Min".split()
TEAM_KEYS = [c for c in PLAYER_KEYS if c not in PERSON_COLUMNS]
PLAYER_GROUP_KEYS = [c for c in PLAYER_KEYS if c not in ("Player_Num", "Pos", "Player_Href")]
LEAGUE_KEYS = ["Country", "Gender", "Tier"]

# Leagues followed, and the first season with advanced statistics.
LEAGUES = [
    ("ENG", "1st", 2018),
    ("GER", "1st", 2018),
    ("ITA", "1st", 2018),
    ("FRA", "1st", 2018),
    ("ESP", "1st", 2018),
    ("USA", "1st", 2018),
    ("ENG", "2nd", 2019),
    ("ENG", "3rd", None),
    ("ENG", "4th", None),
    ("ENG", "5th", None),
]
FIRST_SEASON = 2018


def family_types(family: str) -> dict[str, T.DataType]:
    """Column name to long or double, in declared order."""
    names = [c.strip() for c in FAMILY_COLUMNS[family].replace("\n", " ").split(",")]
    return {n: T.DoubleType() if n in DOUBLE_STATS else T.LongType() for n in names}


def league_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEAGUES, "Country string, Tier string, Min_Advanced_Season bigint")
