"""Networks of turns as XML, checked against a schema file and read back. Every fault has its own turns; the SQL knows which."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.records import work_folder
from ..sources.xml import checked

QUERIES: dict = {}
ORACLE_SQL: dict = {}
XSD = """<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:simpleType name="Role"><xs:restriction base="xs:string"><xs:enumeration value="user"/><xs:enumeration value="assistant"/><xs:enumeration value="system"/></xs:restriction></xs:simpleType>
  <xs:element name="network"><xs:complexType><xs:sequence>
    <xs:element name="size" type="xs:int"/>
    <xs:element name="link" minOccurs="0" maxOccurs="unbounded"><xs:complexType><xs:attribute name="to" type="xs:int" use="required"/></xs:complexType></xs:element>
  </xs:sequence><xs:attribute name="id" type="xs:int" use="required"/><xs:attribute name="role" type="Role"/></xs:complexType></xs:element>
</xs:schema>"""
SCHEMA = "_id int, _role string, size int, link array<struct<_to:int>>"
NETWORKS = """SELECT conv_id, turn, role, k, CASE k % 9 WHEN 0 THEN '<network role="' || role || '"><size>1</size></network>' WHEN 1 THEN '<network id="1" role="nobody"><size>1</size></network>' WHEN 2 THEN '<network id="1"><size>many</size></network>' WHEN 3 THEN '<network id="1"><link to="1"/><size>1</size></network>' WHEN 4 THEN '<network id="1"><size>1</size><link/></network>' WHEN 5 THEN '<network id="1"><size>1</size>'
  ELSE '<network id="' || CAST(turn AS VARCHAR(20)) || '" role="' || role || '"><size>' || CAST(k AS VARCHAR(20)) || '</size>' || repeat('<link to="7"/>', CAST(turn % 3 AS INT)) || '</network>' END AS xml FROM (SELECT conv_id, turn, role, length(text) AS k FROM {conversations}) t"""


def xml_checked(spark, sf_dir):
    xsd = work_folder(spark, "networks") + ".xsd"
    path = spark._jvm.org.apache.hadoop.fs.Path(xsd)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(XSD.encode()))
    out.close()
    t = spark.sql(NETWORKS, conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    c = checked(t, "xml", SCHEMA, xsd)
    return c.select("conv_id", "turn", "is_valid", F.col("doc._id").cast("long").alias("id"), F.col("doc._role").alias("role"), F.col("doc.size").cast("long").alias("size"), F.when(F.col("is_valid"), F.coalesce(F.size("doc.link"), F.lit(0))).cast("long").alias("links"))


QUERIES["xml_checked"] = xml_checked
ORACLE_SQL["xml_checked"] = "SELECT conv_id, turn, length(text) % 9 > 5 AS is_valid, CASE WHEN length(text) % 9 > 5 THEN turn END AS id, CASE WHEN length(text) % 9 > 5 THEN role END AS role, CASE WHEN length(text) % 9 > 5 THEN length(text) END AS size, CASE WHEN length(text) % 9 > 5 THEN turn % 3 END AS links FROM conversations"
