"""The public surface under its task names, for programs that call it as classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillscope.functions.measures import as_double
from tillscope.job import SparkJob
from tillscope.operators.cleaning import clean
from tillscope.plans import results
from tillscope.session import create_spark_session, get_spark_with_hive
from tillscope.sinks.catalog import register_external as create_external_table_from_parquet
from tillscope.sinks.catalog import write_table as write_to_hive
from tillscope.sinks.files import save_results
from tillscope.sources.files import load_merchants, load_transactions

__all__ = [
    "DataLoader",
    "MerchantAnalysis",
    "SparkJob",
    "create_external_table_from_parquet",
    "create_spark_session",
    "get_spark_with_hive",
    "save_results",
    "write_to_hive",
]


class DataLoader:
    """Reads and cleans the inputs."""

    def __init__(self, spark: SparkSession, use_hive: bool = False):
        self.spark = spark
        self.use_hive = use_hive

    def load_transactions(self, path: str) -> DataFrame:
        return load_transactions(self.spark, path)

    def load_merchants(self, path: str) -> DataFrame:
        return load_merchants(self.spark, path)

    def clean_data(self, transactions_df: DataFrame, merchants_df: DataFrame) -> DataFrame:
        return clean(transactions_df, merchants_df)

    def get_cleaned_data(self, transactions_path: str, merchants_path: str) -> DataFrame:
        return clean(self.load_transactions(transactions_path), self.load_merchants(merchants_path))


class MerchantAnalysis:
    """The five tasks over cleaned sales, or over sales totals with the needed keys."""

    def task1_top_merchants_by_city_month(self, df: DataFrame) -> DataFrame:
        return as_double(results.top_merchants_by_month_city(df))

    def task2_average_sale_by_merchant_state(self, df: DataFrame) -> DataFrame:
        return as_double(results.avg_sales_by_merchant_state(df))

    def task3_top_hours_by_category(self, df: DataFrame) -> DataFrame:
        return as_double(results.top_hours_by_category(df))

    def task4_popular_merchants_location_analysis(
        self, df: DataFrame
    ) -> tuple[DataFrame, DataFrame]:
        popular = results.popular_merchants_by_city(df)
        return as_double(popular), as_double(results.city_dominant_categories(df))

    def task5_business_recommendations(self, df: DataFrame) -> dict[str, DataFrame]:
        parts = {
            "top_cities": results.recommendation_top_cities,
            "top_categories": results.recommendation_top_categories,
            "monthly_trends": results.monthly_sales_trends,
            "hourly_patterns": results.hourly_sales_patterns,
            "installment_recommendation": results.installment_profitability_analysis,
        }
        return {name: as_double(build(df)) for name, build in parts.items()}

    def _analyze_installment_profitability(self, installment_df: DataFrame) -> DataFrame:
        return as_double(results.profitability(installment_df))
