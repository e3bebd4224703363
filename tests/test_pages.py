import json

import pytest

from tallysheet.schemas import CLIENT_PAGE
from tallysheet.sources.pages import (
    EmptySource,
    IncompletePages,
    check_pages,
    read_api_pages,
    read_articles,
    read_clients,
    require_nonempty,
)
from tallysheet.sources.tables import encode_nested, register, text_null_policy
from tests.conftest import rows


def land(path, *pages):
    """One pretty-printed file per page, as a download would leave them."""
    for number, items, link in pages:
        doc = {"page": number, "data": items, "links": {"next": link} if link else {}}
        (path / f"page-{number}-{len(list(path.iterdir()))}.json").write_text(json.dumps(doc, indent=2))
    return str(path)


FULL = {
    "type": "client", "id": "1",
    "attributes": {
        "cdCliente": "1", "codigoParticular": "p", "razonSocial": "Name", "nombreFantasia": "F", "vendedor": "7",
        "zona": "Z", "barrio": "(5) x", "localidad": "L", "domicilio": "D", "telefono": "T", "comentario": "C",
        "claveWeb": "unread", "gm": True, "ag": False, "esExcel": True, "esAgro": False, "esPlanGomeria": True,
        "contrareembolso": 1, "contradeposito": 0,
        "cuentaPrincipal": {"codigoCliente": "9", "codigoParticular": "q"},
        "conditions": {"condicion": "CC", "dias": 30, "limiteMonto": 1.5, "monto": 2.5, "plan": 1},
        "discounts": {"byBonus": 1.0, "byCondition": [{"code": "a", "description": "b", "value": 2.0, "other": "c"}], "byBrand": []},
        "coordinates": {"latitude": -34.5, "longitude": None},
        "camposDinamicos": [{"codigo": 1, "descripcion": "d", "nombre": "n", "valor": "v"}],
        "sucursales": [{"id": "s", "localidad": "L", "cp": "1", "zona": None, "direccion": "D", "latitude": 1.0, "longitude": 2.0}],
    },
}
BARE = {"type": "client", "id": "2", "attributes": {"cdCliente": "2", "cuentaPrincipal": None, "vendedor": None, "conditions": {}}}


def test_clients_with_and_without_fields(spark, tmp_path):
    got = read_clients(spark, land(tmp_path, (1, [FULL], "/v1?2"), (2, [BARE], None)))
    full, bare = got.orderBy("codigocliente").collect()
    assert (full.cuenta_principal_codigo, full.vendedor, full.gm, full.latitude, full.longitude) == ("9", "7", True, -34.5, None)
    assert full.discounts.byCondition[0].value == 2.0 and full.sucursales[0].cp == "1"
    assert (bare.cuenta_principal_codigo, bare.vendedor, bare.razonsocial, bare.gm, bare.contrareembolso) == ("", "", "", False, 0)
    assert (bare.latitude, bare.campos_dinamicos, bare.sucursales) == (None, [], [])
    encoded = encode_nested(got, "conditions", "discounts", "sucursales").orderBy("codigocliente").collect()[1]
    assert (encoded.conditions, encoded.discounts, encoded.sucursales) == ("{}", "{}", "[]")


def test_articles(spark, tmp_path):
    full = {"id": "10", "attributes": {"codigoParticular": "p", "descripcion": " d ", "codigoRubro": "r", "codigoMarca": "7", "marca": {"codigoMarca": "7", "descripcion": "B"}, "precioCompra": 1.0}}
    bare = {"id": "11", "attributes": {"marca": None}}
    got = read_articles(spark, land(tmp_path, (1, [full, bare], None)))
    assert rows(got) == [("10", "p", " d ", "r", "7", "B"), ("11", "", "", "", "", "")]


@pytest.mark.parametrize(
    "pages, ok",
    [
        ([(1, [BARE], None)], True),
        ([(1, [BARE], "n"), (2, [BARE], None)], True),
        ([(1, [BARE], "n"), (2, [], None)], True),
        ([(1, [BARE], "n"), (2, [], "n")], True),
        ([(1, [BARE], "n")], False),
        ([(1, [BARE], "n"), (3, [BARE], None)], False),
        ([(1, [BARE], None), (2, [BARE], None)], False),
        ([(1, [BARE], "n"), (1, [BARE], "n"), (2, [BARE], None)], False),
        ([(1, [BARE], "n"), (2, [], "n"), (3, [BARE], None)], False),
        ([(2, [BARE], None)], False),
    ],
)
def test_page_set(spark, tmp_path, pages, ok):
    landed = read_api_pages(spark, land(tmp_path, *pages), CLIENT_PAGE)
    if ok:
        check_pages(landed)
    else:
        with pytest.raises(IncompletePages):
            check_pages(landed)


@pytest.mark.parametrize(
    "pages, ok",
    [
        ([(1, [BARE], "/v1?page=2"), (2, [BARE], "/v1?page=3"), (3, [BARE], None)], True),
        ([(1, [BARE], None)], True),
        ([(1, [BARE], "/v1?page=2"), (3, [BARE], None)], False),
        ([(1, [BARE], "/v1?page=2")], False),
        ([(1, [BARE], None), (2, [BARE], None)], False),
    ],
)
def test_bodies_of_data_and_links_only(spark, tmp_path, pages, ok):
    """The number comes from the file name, or, many pages to a file, from the link."""
    bodies = [(n, {"data": items, "links": {"next": link} if link else {}}) for n, items, link in pages]
    files, lines = tmp_path / "files", tmp_path / "lines"
    files.mkdir()
    lines.mkdir()
    for n, body in bodies:
        (files / f"clients-{n:03d}.json").write_text(json.dumps(body, indent=2))
    (lines / "all.json").write_text("\n".join(json.dumps(body) for _, body in bodies))
    landed = [read_api_pages(spark, str(files), CLIENT_PAGE)]
    if len(pages) != 2 or ok:
        landed.append(read_api_pages(spark, str(lines), CLIENT_PAGE, multi_line=False))
    for found in landed:
        if ok:
            check_pages(found)
            assert sorted(r.page for r in found.select("page").collect()) == [n for n, _, _ in pages]
        else:
            with pytest.raises(IncompletePages):
                check_pages(found)


def test_no_resources_is_an_error(spark, tmp_path):
    with pytest.raises(EmptySource):
        read_clients(spark, land(tmp_path, (1, [], None)))
    df = spark.range(1)
    assert require_nonempty(df, "x") is df


def test_null_policy_and_views(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "n int, t string")
    assert rows(text_null_policy(df)) == [(1, None), (2, ""), (3, "x")]
    assert rows(text_null_policy(df, "blank")) == [(1, ""), (2, ""), (3, "x")]
    assert rows(text_null_policy(df, "null")) == [(1, None), (2, None), (3, "x")]
    with pytest.raises(ValueError):
        text_null_policy(df, "drop")
    register(df, "some_model")
    assert spark.table("some_model").count() == 3
