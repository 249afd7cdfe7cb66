"""Declared layouts of the raw deliveries. Raw text columns stay text until they are cleaned."""

from __future__ import annotations

from pyspark.sql import types as T


def text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def snake(name: str) -> str:
    """Internal column name of a report header."""
    out = "".join(ch.lower() if ch.isalnum() else "_" for ch in name.replace("#", "number"))
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")


# fixed values: headers of the deliveries, in file order
REGIONAL_US = text(
    "Branch", "Business Unit", "SIC Code", "SIC Sub", "Customer Nbr.", "Customer Name",
    "Customer Address1", "Customer Address2", "Customer City", "Customer State", "Customer Zip",
    "Family", "Brand", "Group", "Manufacture Prod.Nbr.", "Prod Nbr", "Product", "Pack / Size",
    "Product Ext.Description", "Week of", "Month", "LBS")
NATIONAL_US_WEEKLY = text(
    "Region", "Area", "Market", "Pyramid Segment", "Business Unit", "Merch Category", "PIM Group",
    "MFG #", "PIM #", "ASYS #", "Product Description", "Pack Size", "Vendor #", "Vendor", "Brand",
    "Brand Type", "Attribute 1", "Attribute 2", "Attribute 3", "Attribute 4", "Attribute 5", "Year Week", "LB Current")
NATIONAL_US_SHARED = text(
    "Area", "Market", "Pyramid Segment", "ASYS Code", "ASYS", "GTIN", "MFG Number", "LBS")
NATIONAL_US_REPORT = text(
    "Division", "Sales Manager", "Sales Rep Number", "Sales Rep", "Account Number", "Account Name", "Address", "City", "State",
    "Postal Code", "Customer Class", "Segment", "Account Type", "Vendor", "Manufacturer", "Brand", "Brand Type",
    "Product Category", "Sub-Category",
    "GTIN", "MFR SKU", "Dist SKU", "Item Name", "Pack", "Size", "Unit Type", "Qty", "Weight")
FAIR_SHARE_KEYS = ("Merch Category", "Region", "Area", "Market", "Pyramid Segment", "Brand Type", "PIM Group")
FAIR_SHARE_MEASURES = (
    "LB Category Previous", "LB Category Current", "LB Vendor Previous", "LB Vendor Current",
    "Fair Share Opportunity Previous", "Fair Share Opportunity Current")
RELEASES = T.StructType([T.StructField("releases", T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()), T.StructField("realtime_start", T.StringType()),
    T.StructField("realtime_end", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("press_release", T.BooleanType()), T.StructField("link", T.StringType()),
    T.StructField("notes", T.StringType()),
])))])
