"""C14 lookup data: the register's county -> city table (as data, joined, never a UDF)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# county/district name -> prefecture city used by the register's map view,
# in the order the source lists them (one name appears twice with the same city).
COUNTY_TO_CITY = {
    '中原区': '郑州市', '二七区': '郑州市', '管城回族区': '郑州市', '金水区': '郑州市',
    '上街区': '郑州市', '惠济区': '郑州市', '中牟县': '郑州市', '巩义市': '郑州市',
    '荥阳市': '郑州市', '新密市': '郑州市', '新郑市': '郑州市', '登封市': '郑州市',
    '郑东新区': '郑州市', '高新区': '郑州市', '经开区': '郑州市', '航空港经济试验区': '郑州市',
    '龙亭区': '开封市', '顺河回族区': '开封市', '鼓楼区': '开封市', '禹王台区': '开封市',
    '祥符区': '开封市', '杞县': '开封市', '通许县': '开封市', '尉氏县': '开封市',
    '兰考县': '开封市', '示范区': '开封市', '市示范区': '开封市', '老城区': '洛阳市',
    '西工区': '洛阳市', '瀍河回族区': '洛阳市', '涧西区': '洛阳市', '吉利区': '洛阳市',
    '洛龙区': '洛阳市', '孟津县': '洛阳市', '新安县': '洛阳市', '栾川县': '洛阳市',
    '嵩县': '洛阳市', '汝阳县': '洛阳市', '宜阳县': '洛阳市', '洛宁县': '洛阳市',
    '伊川县': '洛阳市', '偃师市': '洛阳市', '伊滨区': '洛阳市', '新华区': '平顶山市',
    '卫东区': '平顶山市', '石龙区': '平顶山市', '湛河区': '平顶山市', '宝丰县': '平顶山市',
    '叶县': '平顶山市', '鲁山县': '平顶山市', '郏县': '平顶山市', '舞钢市': '平顶山市',
    '汝州市': '平顶山市', '文峰区': '安阳市', '北关区': '安阳市', '殷都区': '安阳市',
    '龙安区': '安阳市', '安阳县': '安阳市', '汤阴县': '安阳市', '滑县': '安阳市',
    '内黄县': '安阳市', '林州市': '安阳市', '鹤山区': '鹤壁市', '山城区': '鹤壁市',
    '淇滨区': '鹤壁市', '浚县': '鹤壁市', '淇县': '鹤壁市', '红旗区': '新乡市',
    '卫滨区': '新乡市', '凤泉区': '新乡市', '牧野区': '新乡市', '新乡县': '新乡市',
    '获嘉县': '新乡市', '原阳县': '新乡市', '延津县': '新乡市', '封丘县': '新乡市',
    '长垣县': '新乡市', '卫辉市': '新乡市', '辉县市': '新乡市', '平原示范区': '新乡市',
    '解放区': '焦作市', '中站区': '焦作市', '马村区': '焦作市', '山阳区': '焦作市',
    '修武县': '焦作市', '博爱县': '焦作市', '武陟县': '焦作市', '温县': '焦作市',
    '沁阳市': '焦作市', '孟州市': '焦作市', '华龙区': '濮阳市', '清丰县': '濮阳市',
    '南乐县': '濮阳市', '范县': '濮阳市', '台前县': '濮阳市', '濮阳县': '濮阳市',
    '魏都区': '许昌市', '建安区': '许昌市', '鄢陵县': '许昌市', '襄城县': '许昌市',
    '禹州市': '许昌市', '长葛市': '许昌市', '源汇区': '漯河市', '郾城区': '漯河市',
    '召陵区': '漯河市', '舞阳县': '漯河市', '临颍县': '漯河市', '湖滨区': '三门峡市',
    '陕州区': '三门峡市', '渑池县': '三门峡市', '卢氏县': '三门峡市', '义马市': '三门峡市',
    '灵宝市': '三门峡市', '宛城区': '南阳市', '卧龙区': '南阳市', '南召县': '南阳市',
    '方城县': '南阳市', '西峡县': '南阳市', '镇平县': '南阳市', '内乡县': '南阳市',
    '淅川县': '南阳市', '社旗县': '南阳市', '唐河县': '南阳市', '新野县': '南阳市',
    '桐柏县': '南阳市', '邓州市': '南阳市', '梁园区': '商丘市', '睢阳区': '商丘市',
    '民权县': '商丘市', '睢县': '商丘市', '宁陵县': '商丘市', '柘城县': '商丘市',
    '虞城县': '商丘市', '夏邑县': '商丘市', '永城市': '商丘市', '浉河区': '信阳市',
    '平桥区': '信阳市', '罗山县': '信阳市', '光山县': '信阳市', '新县': '信阳市',
    '商城县': '信阳市', '固始县': '信阳市', '潢川县': '信阳市', '淮滨县': '信阳市',
    '息县': '信阳市', '川汇区': '周口市', '扶沟县': '周口市', '西华县': '周口市',
    '商水县': '周口市', '沈丘县': '周口市', '郸城县': '周口市', '淮阳县': '周口市',
    '太康县': '周口市', '鹿邑县': '周口市', '项城市': '周口市', '黄泛区': '周口市',
    '驿城区': '驻马店市', '西平县': '驻马店市', '上蔡县': '驻马店市', '平舆县': '驻马店市',
    '正阳县': '驻马店市', '确山县': '驻马店市', '泌阳县': '驻马店市', '汝南县': '驻马店市',
    '遂平县': '驻马店市', '新蔡县': '驻马店市', '济源': '济源市', '济源市': '济源市',
    '示范区': '开封市', '开发区': '郑州市', '工业园区': '郑州市', '经济技术开发区': '郑州市',
    '新城区': '郑州市', '城乡一体化示范区': '郑州市', '东城区': '郑州市',
}


def county_city_lookup(spark: SparkSession) -> DataFrame:
    """The fixed table as a two-column DataFrame (from_name, to_name) for ``remap``."""
    return spark.createDataFrame(list(COUNTY_TO_CITY.items()), "from_name string, to_name string")
