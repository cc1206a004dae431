"""Where the pipelines read and write."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# The layout of the inputs below the raw root.
INPUTS = {
    "deposits": "deposit/MineralDeposits.json",
    "major_projects": "deposit/MajorResourceProjects.csv",
    "mine_view": "deposit/MineView.csv",
    "commodity_mapping": "deposit/commodity_mapping.csv",
    "categorization": "deposit/categorization.csv",
    "register": "company/COMPANY_202509.tsv",
    "descriptions": "company/bloomberg/TICKER_NAME_DES.csv",
    "icb_folder": "company/bloomberg/ICB",
    "bics_folder": "company/bloomberg/BICS",
    "profiles": "company/linkedin_unpickled/linkedin_mining_companies.csv",
    "statements": "company/modern_slavery/cleaned_ms_statements.csv",
    "manual_aliases": "company/manual_add_company_names.csv",
    "provinces": "shp/116823_AGP_2018/ProvinceFullExtent.shp",
    "areas": "shp/LGA_2025_AUST_GDA94/LGA_2025_AUST_GDA94.shp",
}

# The layout of the outputs below the root of results.
OUTPUTS = {
    "deposits": "processed/MineralDeposits.csv",
    "market_companies": "processed/Bloomberg_Companies.csv",
    "merged_companies": "processed/CompanyData_Merged.csv",
    "former_names": "processed/Former_Names.csv",
    "project_names": "processed/JSON_Companies.csv",
    "matches": "processed/Matches_Scores_JSON.csv",
    "owners": "processed/Project_Company_Matches.csv",
    "statement_log": "processed/Matches_Scores_Bloomberg_to_MS_Log.csv",
    "profile_log": "processed/Matches_Scores_Merged_to_Linkedin_Log.csv",
    "unmatched_log": "processed/Unmatched_JSON_Companies_Log.csv",
    "projects": "master/ProjectData_Master.csv",
    "companies": "master/CompanyData_Master.csv",
    "changes_log": "master/ACN_Merge_Changes_Log.csv",
    "graph": "graph",
    "project_nodes": "graph/node_Project.csv",
    "commodity_nodes": "graph/node_Commodity.csv",
    "group_nodes": "graph/node_CommodityGroup.csv",
    "group_edges": "graph/rel_Grouped_as.csv",
}


@dataclass(frozen=True)
class EngineConfig:
    """Paths of inputs and outputs by name, any scheme Spark reads.

    Environment variables TESSERA_RAW and TESSERA_OUT override the roots, and
    TESSERA_IN_<NAME> and TESSERA_OUT_<NAME> the place of one file. A name that is not in the tables
    is taken as a path below the root.
    """

    raw: str = field(default_factory=lambda: os.environ.get("TESSERA_RAW", "data/raw"))
    out: str = field(default_factory=lambda: os.environ.get("TESSERA_OUT", "data/out"))

    def source(self, name: str) -> str:
        return os.environ.get(f"TESSERA_IN_{name.upper()}") or f"{self.raw}/{INPUTS.get(name, name)}"

    def target(self, name: str) -> str:
        return os.environ.get(f"TESSERA_OUT_{name.upper()}") or f"{self.out}/{OUTPUTS.get(name, name)}"

    def ready(self, spark: SparkSession, name: str) -> str:
        """The place of an output, the folders above it made, on whatever store it is."""
        path = self.target(name)
        above = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
        above.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(above)
        return path

    def missing(self, spark: SparkSession) -> list[str]:
        """The names of the inputs that are not there."""
        from tessera.sources.readers import exists

        return [n for n in INPUTS if not exists(spark, self.source(n))]
